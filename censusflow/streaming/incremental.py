"""Stages 3-4 on a stream of raw export files; gate and append per micro-batch."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_survey
from ..operators.gate_state import gate_state, read_states, state_findings, write_state
from ..operators.quality import enforce_gate
from ..operators.transform import display_frame, transform_survey
from ..plans.view import publish_projection
from ..session import ensure_checkpoint_dir


def _epochs(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the ``epoch=<id>`` folders in ``folder``, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("epoch="))


def publish_stream(raw_stream: DataFrame, table_path: str, policy: str = "report",
                   checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Clean and transform each arriving export, gate it, append it to the published table.

    ``raw_stream`` is a streaming DataFrame of raw exports (``readStream`` with an
    explicit schema).  A micro-batch that fails the gate raises, so the query
    stops before anything of that batch is written; batches already written
    stay.  Each batch has a folder ``epoch=<id>`` of its own and overwrites it, so a
    batch that is replayed after a failure is there once.  The state of a batch's checks is written to ``_gate/epoch=<id>``, and
    the gate judges all batches so far by their states: a row that repeats one of an earlier batch is a duplicate.  Progress is kept in ``checkpoint`` (default: a folder
    under ``spark.checkpoint.dir``), so a restarted query resumes where it stopped.
    """
    spark = raw_stream.sparkSession
    checkpoint = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "streams", "publish")
    staged = display_frame(transform_survey(clean_survey(raw_stream)))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            root = table_path.rstrip("/")
            own = write_state(gate_state(batch), f"{root}/_gate/epoch={epoch_id}")
            earlier = [f"{root}/_gate/epoch={e}" for e in _epochs(batch.sparkSession, f"{root}/_gate") if e < epoch_id]
            enforce_gate(state_findings(read_states(batch.sparkSession, [*earlier, own]), examples=False), policy)
            publish_projection(batch).write.mode("overwrite").parquet(f"{root}/epoch={epoch_id}")
        finally:
            batch.unpersist()

    writer = staged.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
