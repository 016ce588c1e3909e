"""Shared plumbing: written intermediates in the cluster's checkpoint folder, bounded filters, text batches."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusflow.session import ensure_checkpoint_dir, share_package


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files, and a frame used twice is computed once.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with _shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def materialize_narrow(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` for what a join or aggregation makes of rows of a few numbers: files for a quarter of the session's
    shuffle partitions, which grow with the data. Not for what stands behind a pass over texts or tiles: a coalesce
    takes everything up to the last shuffle into its tasks. Coalescing never adds tasks."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) // 4
    return materialize(df.coalesce(max(parts, spark.sparkContext.defaultParallelism)), name)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffle files of the queries run inside as each of them ends: their result is written."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries run inside send at most ``rows`` rows at a time to Python workers: of whole texts, the 10,000 that Spark
    sends take tens of MB in the worker and again in the JVM's buffers, for each core."""
    before = spark.conf.get(_ROWS)
    spark.conf.set(_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, before)


def discard(df: DataFrame) -> None:
    """Delete a materialized intermediate that no later step reads."""
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def string_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (n + 1, from 0) of a string array; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offs - offs[0]


def row_slices(offsets: np.ndarray, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` bytes each (a longer single text is a range of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim  # glibc only
except (OSError, AttributeError):
    _TRIM = None


#: Bits of a Bloom filter: at least and at most (128 MB).
BLOOM_LEAST, BLOOM_MOST = 20, 30


def bloom_bits(n: int) -> int:
    """Eight bits or more for each of ``n`` values, up to ``BLOOM_MOST``."""
    return min(max((8 * n - 1).bit_length() if n else 0, BLOOM_LEAST), BLOOM_MOST)


def bloom_words(df: DataFrame, column: str) -> np.ndarray:
    """A one-hash Bloom filter of the long column, sized by the number of rows.

    Built by a distributed bitwise OR; an eighth of its bits in bytes reach the driver (``BLOOM_MOST`` bounds them).
    Beyond that it fills and lets more rows through; the join behind it stays exact.
    """
    bits = bloom_bits(df.count())
    rows = df.select(F.expr(f"shiftrightunsigned({column}, {64 - bits + 6})").alias("w"),
                     F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))").alias("b"))
    got = rows.groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    out = np.zeros(1 << (bits - 6), np.uint64)
    for r in got:
        out[r["w"]] = np.uint64(r["b"] & 0xFFFFFFFFFFFFFFFF)
    return out


def bloom_has(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = len(words).bit_length() + 5
    pos = h.view(np.uint64) >> np.uint64(64 - bits)
    return ((words[pos >> np.uint64(6)] >> (pos & np.uint64(63))) & np.uint64(1)).astype(bool)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array of consecutive runs of ``values``."""
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))


def binary_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary array of consecutive byte runs of ``values`` (lengths count bytes)."""
    offs = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offs[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])
