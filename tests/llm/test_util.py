"""Batches that Python workers get."""

import pyarrow as pa

from censusflow.llm import packing
from censusflow.llm.tokenize import tokenizer_path
from censusflow.llm.util import arrow_rows


def test_packing_gets_texts_in_small_batches(spark, monkeypatch):
    seen, real = [], packing.materialize

    def watch(df, name):
        seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return real(df, name)
    monkeypatch.setattr(packing, "materialize", watch)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    assert packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json")).count() == 2
    assert seen == [str(packing.TEXT_ROWS)] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_arrow_rows_bounds_batches(spark):
    def run(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    with arrow_rows(spark, 100):
        got = [r.n for r in spark.range(0, 1000, 1, 1).mapInArrow(run, "n long").collect()]
    assert sum(got) == 1000 and max(got) <= 100
