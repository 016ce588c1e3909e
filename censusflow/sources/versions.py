"""Tables that change as a whole: a folder of Parquet parts and numbered manifests.

A load writes its rows into a part of its own, counts them, lets the caller verify the table as it would be, and only then adds
the next manifest, which lists the parts that make up the table. The manifest is put in place by a rename that fails where
that number is taken, so readers see the old table or the new one, and of two loads at once one is refused. A
failed load leaves parts that no manifest names. ``rollback`` adds a manifest that repeats an older one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col_of


class LoadCountMismatch(RuntimeError):
    """Rows were lost or added between staging and the written part."""


class VersionConflict(RuntimeError):
    """Another load has changed the table since this one began."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/manifests/{number:010d}.json"


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the newest manifest; 0 if there is none."""
    at, fs = _fs(spark, f"{path.rstrip('/')}/manifests")
    if not fs.exists(at):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "_"), default=0)


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict:
    """Parts, rows and parent of a version (default: the current one)."""
    number = current_version(spark, path) if number is None else number
    at, fs = _fs(spark, _manifest(path, number))
    if not number or not fs.exists(at):
        raise FileNotFoundError(f"{path} has no version {number}")
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, number: int, body: dict) -> None:
    target = _manifest(path, number)
    draft, fs = _fs(spark, f"{path.rstrip('/')}/manifests/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(body).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, jvm.org.apache.hadoop.fs.Path(target), never_replace)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(jvm.org.apache.hadoop.fs.Path(target)):
            raise VersionConflict(f"version {number} of {path} was written by another load") from e
        raise


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of a version (default: the current one)."""
    body = manifest(spark, path, number)
    from pyspark.sql.types import StructType
    return spark.read.schema(StructType.fromJson(body["schema"])).parquet(*[f"{path.rstrip('/')}/{p}" for p in body["parts"]])


def publish_version(df: DataFrame, path: str, append: bool = False, verify: Callable[[DataFrame], None] | None = None,
                    expected_rows: int | None = None, notes: dict[str, list] | None = None) -> DataFrame:
    """Write ``df`` as the next version of the table (with ``append``: after the current parts) and return that version.

    The rows are counted while they are written and again in the part's footers; ``expected_rows`` is compared with both.
    ``verify`` gets the whole table as it would be and raises to refuse it. An append takes the table's columns by
    name and casts them to its types. ``notes`` are lists kept in the manifest under their names; an append's follow the
    table's. Nothing that raises changes what readers see.
    """
    spark, base = df.sparkSession, current_version(df.sparkSession, path)
    before = manifest(spark, path, base) if base else {"parts": [], "rows": 0}
    if append and base:
        target = read_version(spark, path, base).schema
        missing = [f.name for f in target.fields if f.name not in df.columns]
        if missing:
            raise KeyError(f"frame lacks table columns: {missing}")
        df = df.select(*[col_of(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    part = f"parts/{uuid.uuid4().hex}"
    seen = Observation(part)
    df.observe(seen, F.count(F.lit(1)).alias("staged")).write.parquet(f"{path.rstrip('/')}/{part}")
    staged, written = seen.get["staged"], spark.read.parquet(f"{path.rstrip('/')}/{part}").count()
    if staged != written or expected_rows not in (None, written):
        raise LoadCountMismatch(f"{expected_rows if expected_rows is not None else staged} rows were expected, {staged} staged and {written} written")
    kept = before["parts"] if append else []
    parts, rows = [*kept, part], written + (before["rows"] if append else 0)
    schema = df.schema
    if verify is not None:
        verify(spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{p}" for p in parts]))
    noted = dict(before.get("notes", {})) if append else {}
    noted |= {k: noted.get(k, []) + v for k, v in (notes or {}).items()}
    _commit(spark, path, base + 1, {"version": base + 1, "parent": base, "rows": rows, "parts": parts, "schema": json.loads(schema.json()), "notes": noted})
    return read_version(spark, path, base + 1)


def rollback(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Make an older version the current one again (as a new version) and return it."""
    body, base = manifest(spark, path, number), current_version(spark, path)
    _commit(spark, path, base + 1, {**body, "version": base + 1, "parent": base})
    return read_version(spark, path, base + 1)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the parts (and noted folders) that none of the newest ``keep`` versions names; how many. Not to be run beside a load."""
    newest = current_version(spark, path)
    kept = [manifest(spark, path, n) for n in range(max(1, newest - keep + 1), newest + 1)]
    named = {p for m in kept for p in (*m["parts"], *(x for note in m.get("notes", {}).values() for x in note))}
    gone = []
    for folder in {"parts", *(p.split("/")[0] for p in named)}:
        at, fs = _fs(spark, f"{path.rstrip('/')}/{folder}")
        gone += [f.getPath() for f in fs.listStatus(at) if f"{folder}/{f.getPath().getName()}" not in named]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
