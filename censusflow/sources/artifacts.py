"""Written artifacts in the shared checkpoint folder.

Writing a stage's output and reading it back cuts the lineage (a lost executor
re-reads files instead of recomputing the whole upstream plan) and makes a
check inspect exactly the artifact that is about to be loaded.  The folder is
``spark.checkpoint.dir``; on a cluster that names shared storage.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_WRITTEN: dict[tuple[str, str], str] = {}


def artifact_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    base = ensure_checkpoint_dir(spark)
    suffix = f"-{uuid.uuid4().hex[:10]}" if unique else ""
    return os.path.join(base, "artifacts", name + suffix)


def input_identity(spark: SparkSession, folder: str) -> str:
    """Digest of the paths, sizes and modification times of the files below ``folder`` (listed by Spark's file system)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return folder
    files, seen = fs.listFiles(root, True), []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()


def materialize(df, name: str, key: str = "", spark: SparkSession | None = None) -> DataFrame:
    """Write a frame as Parquet once per (name, key) in this application and read it back.

    This is an eager step: the write job runs here.  ``key`` is the source folder; the
    identity of its files is part of the cache key, so changed tables are read anew.
    ``df`` may be a DataFrame or a zero-argument builder (then ``spark`` is required),
    so an already written artifact costs no planning at all.
    """
    spark = spark if spark is not None else df.sparkSession
    tag = (spark.sparkContext.applicationId, name + "|" + key + "|" + (input_identity(spark, key) if key else ""))
    path = _WRITTEN.get(tag)
    if path is None:
        df = df() if callable(df) else df
        digest = hashlib.sha1(tag[1].encode()).hexdigest()[:12]
        path = artifact_path(spark, f"{name}-{digest}")
        df.write.mode("overwrite").parquet(path)
        _WRITTEN[tag] = path
    return spark.read.parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate in a folder of its own and read it back: values that must not change are fixed, lineage ends."""
    path = artifact_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
