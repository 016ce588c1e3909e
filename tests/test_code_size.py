"""Generated code stays small: the JVM never compiles a method of more than 8,000 bytecodes."""

import re

from pyspark.sql import functions as F

from censusflow.functions.columns import round_half_even_ratio
from censusflow.functions.money import with_midpoints, with_stripped

LIMIT = 8000


def sizes(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))]


def test_five_label_columns(spark):
    names = ["a", "b", "c", "d", "e"]
    rows = [("< 500", "500 - 1,000 ₹", "Rs. 2000 - 1000", "> ５０００", None), ("about 2k", "", "1500", "3000 – 4000 â‚¹", "\u2488-2")]
    df = spark.createDataFrame(rows, names).repartition(2)
    mid = with_midpoints(df, {f"m_{c}": c for c in names}).select(*[f"m_{c}" for c in names])
    text = with_stripped(df, {f"t_{c}": c for c in names}).select(*[f"t_{c}" for c in names])
    usage = mid.select(round_half_even_ratio(F.col("m_a").cast("long") * 100, F.col("m_b").cast("long"), 1).alias("u"))
    for plan in (mid, text, usage):
        assert max(sizes(plan), default=0) <= LIMIT
    assert sorted(map(tuple, mid.collect()), key=str) == sorted([(250.0, 750.0, 1500.0, 6250.0, None), (None, None, None, 3500.0, 1.5)], key=str)
    assert {r.t_c for r in text.collect()} == {"2000 - 1000", "1500"} and {r.t_e for r in text.collect()} == {"", "1.-2"}
    assert {r.u for r in usage.collect()} == {33.3, None}


def test_raw_export(spark, sf_dir):
    # the rendering of the export was part of the joins' method (13,493 bytecodes, never compiled)
    from censusflow.sources.binding import survey_raw
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = sizes(survey_raw(spark, sf_dir))
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    assert found and max(found) <= LIMIT
