"""Sources and sinks: the raw export, string-only CSV scans, table writes.

* ``read_raw_csv``      - S1/S2: CSV with an explicit all-string schema (never
  ``inferSchema``); optional ``blank_strings`` turns Spark's NULL for an empty
  field into ``''`` (the loader reads blanks as text, not missing values).
* ``write_csv``         - S4: distributed CSV write; whitespace is kept (Spark's
  writer trims by default), nothing is coalesced to one file.
* ``publish_table``     - S5: publish the typed table as a new version; the written row
  count is held against the staged count, observed during the same write (no extra scan).
* ``append_by_name``    - S7: append a frame to a published table by the
  table's own column list, as a new version.
* ``write_json``        - S8: JSON sink for the quality report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col_of
from .versions import publish_version

_CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false", "escape": '"'}


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header line, whitespace preserved, one file per partition."""
    df.write.mode("overwrite").options(**_CSV_WRITE).csv(path)
    return path


#: A quoted cell may hold a newline; such files are read whole, one task per file.
_CSV_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


class HeaderMismatch(ValueError):
    """The header line of a CSV names other columns than those asked for."""


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names of the header line (reads the first line only)."""
    return spark.read.options(**{**_CSV_READ, "inferSchema": "false"}).csv(path).columns


def _by_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The file's own column order, typed by name; an absent column raises, extra ones are left out."""
    names = csv_header(spark, path)
    absent = [f.name for f in schema.fields if f.name not in names]
    if absent:
        raise HeaderMismatch(f"{path} has no column {absent}; its header is {names}")
    types = {f.name: f.dataType for f in schema.fields}
    own = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    return spark.read.schema(own).options(**_CSV_READ).csv(path).select(*[col_of(f.name) for f in schema.fields])


def read_raw_csv(spark: SparkSession, path: str, columns, blank_strings: bool = False) -> DataFrame:
    """The named columns as text, found by the file's header line, in the order of ``columns``."""
    df = _by_header(spark, path, string_schema(columns))
    if blank_strings:
        df = df.select(*[F.coalesce(col_of(c), F.lit("")).alias(c) for c in df.columns])
    return df


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _by_header(spark, path, schema)


def publish_table(df: DataFrame, path: str) -> DataFrame:
    """Publish ``df`` as the table at ``path``; readers see the old table until the rows are written and counted."""
    return publish_version(df, path)


def append_by_name(df: DataFrame, path: str, verify=None) -> DataFrame:
    """Append to the table at ``path`` by its own column list and types; ``verify`` sees the whole table before readers do."""
    return publish_version(df, path, append=True, verify=verify)


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per result row."""
    df.write.mode("overwrite").json(path)
    return path


def report_envelope(results: DataFrame, row_count: DataFrame, policy: str = "report") -> DataFrame:
    """The quality report as one JSON-ready row: rows checked, decision, counts by severity, all results.

    ``results`` has one row per check (about 65), so collecting them into one array is bounded;
    ``row_count`` is a one-row frame with ``n``.
    """
    failed = ~F.col("passed")
    tiers = {"off": [], "report": ["CRITICAL"], "verbose": ["CRITICAL"], "strict": ["CRITICAL", "WARNING"]}[policy]
    severity = lambda s: F.count(F.when(failed & (F.col("severity") == s), 1))
    body = results.agg(
        (F.count(F.when(failed & F.col("severity").isin(*tiers), 1)) == 0).alias("passed"),
        F.struct(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("passed"), 1)).alias("passed"),
                 F.count(F.when(F.col("severity") == "SKIPPED", 1)).alias("skipped"),
                 severity("CRITICAL").alias("critical"), severity("WARNING").alias("warning"), severity("INFO").alias("info")).alias("summary"),
        F.sort_array(F.collect_list(F.struct(*results.columns))).alias("results"))
    n = row_count.select("n").first()["n"]
    return body.select(F.lit(n).cast("long").alias("row_count"), F.lit(policy).alias("policy"), "passed", "summary", "results")
