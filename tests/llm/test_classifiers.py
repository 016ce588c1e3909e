import zlib

import numpy as np
import pytest

from censusflow.llm.fitting import isotonic, logistic
from censusflow.llm.quality import quality
from censusflow.llm.toxicity import FEATURES, Lexicon, _hash_of, features, toxicity
from censusflow.llm.util import string_buffer

DATA = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.mark.parametrize("run,label,modulus,held", [(quality, "quality", 3, 1), (toxicity, "toxic", 5, 0)])
def test_held_out_accuracy(spark, run, label, modulus, held):
    docs, labels = tables(spark)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    rows = run(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in test]) > 0.93


@pytest.mark.parametrize("run", [quality, toxicity])
def test_odd_tables(spark, run):
    schema = "doc_id long, text string, score string, y int, part int"
    docs = spark.createDataFrame([(1, None, "", 0, 0), (2, "", "", 0, 0), (3, "x" * 200_000, "", 0, 0), (None, "text", "", 0, 0), (4, "a b", "", 0, 0), (4, "a b", "", 0, 0)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (4, 1, None), (None, 1, 1), (9, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one, some):
        rows = run(docs, labels).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert run(docs.limit(0), none).collect() == []


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = tables(spark)
    from pyspark.sql import functions as F
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality(docs, labels).collect(), quality(docs, flipped).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_features_of_texts():
    import pyarrow as pa
    words = _hash_of(["trash"])
    lex = Lexicon(words, np.array([3.0]))
    x = {t: dict(zip(FEATURES, row)) for t, row in zip(
        ["", "you are trash", "plain words", "TR4SH and tr@sh!", "trash far away from the word you", "sooo LOUD!!!"],
        features(*string_buffer(pa.array(["", "you are trash", "plain words", "TR4SH and tr@sh!", "trash far away from the word you", "sooo LOUD!!!"])), lex))}
    assert not any(x[""].values())
    assert x["you are trash"]["lexicon"] == pytest.approx(1 / 3) and x["you are trash"]["strongest"] == 3
    assert x["you are trash"]["nearness"] > x["trash far away from the word you"]["nearness"] > 0
    assert x["TR4SH and tr@sh!"]["disguised"] > 0 and x["plain words"]["disguised"] == 0
    assert x["sooo LOUD!!!"]["repeated"] > 0 and x["sooo LOUD!!!"]["capital_words"] > 0


def test_isotonic_and_logistic():
    x, y = np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0, 1, 0, 1, 1])
    knots, means = isotonic(x, y)
    assert (np.diff(means) > 0).all() and means[0] == 0 and means[-1] == 1
    rng = np.random.default_rng(0)
    z = rng.normal(size=(2000, 1))
    w = logistic(np.c_[np.ones(2000), z], (rng.random(2000) < 1 / (1 + np.exp(-2 * z[:, 0]))).astype(float), np.ones(2000))
    assert abs(w[1] - 2) < 0.3
    # a sample with every tenth row of a class, weighted by ten, has the whole table's intercept
    y = (rng.random(2000) < 1 / (1 + np.exp(-z[:, 0] + 1))).astype(float)
    rare = (y == 1) | (np.arange(2000) % 10 == 0)
    full = logistic(np.c_[np.ones(2000), z], y, np.ones(2000))
    part = logistic(np.c_[np.ones(rare.sum()), z[rare]], y[rare], np.where(y[rare] == 1, 1.0, 10.0))
    assert abs(part[0] - full[0]) < 0.5 < abs(logistic(np.c_[np.ones(rare.sum()), z[rare]], y[rare], np.ones(rare.sum()))[0] - full[0])
