"""The load path applied per micro-batch (file source -> clean/transform -> gate -> append)."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from censusflow.plans import pipeline
from censusflow.streaming import publish_stream


def test_stream_publishes_every_row(spark, sf_dir):
    raw = pipeline.raw_export(spark, sf_dir)
    src = raw.inputFiles()[0].rsplit("/", 1)[0]
    out = os.path.join(tempfile.mkdtemp(prefix="cf-stream-"), "students_budget")
    stream = spark.readStream.schema(raw.schema).parquet(src)
    q = publish_stream(stream, out, policy="off",
                       checkpoint=os.path.join(os.path.dirname(out), "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    published = spark.read.parquet(out)
    assert published.count() == pipeline.published_table(spark, sf_dir).count()


def test_a_batch_is_judged_with_those_before_it(spark, sf_dir):
    raw, folder = pipeline.raw_export(spark, sf_dir), tempfile.mkdtemp(prefix="cf-stream-")
    src, out, ckpt = (os.path.join(folder, x) for x in ("in", "table", "ckpt"))
    rows = raw.filter("response_id >= 0").orderBy("response_id").limit(40)

    def run(policy):
        q = publish_stream(spark.readStream.schema(raw.schema).parquet(src), out, policy=policy, checkpoint=ckpt)
        try:
            q.awaitTermination(300)
        finally:
            q.stop()
    rows.coalesce(1).write.mode("append").parquet(src)
    run("off")
    n = spark.read.parquet(out).count()
    rows.limit(1).write.mode("append").parquet(src)
    with pytest.raises(StreamingQueryException, match="exact_duplicate_rows"):
        run("report")
    assert spark.read.parquet(out).count() == n
    run("off")
    assert spark.read.parquet(out).count() == n + 1
