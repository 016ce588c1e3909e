"""Bind the driver's star-schema tables onto survey-shaped inputs.

One survey response per order.  Amounts are integer functions of the order's
line items and total price, so the result is deterministic and identical in any
engine that uses the same integer arithmetic.

* ``survey_amounts``  - key, categorical answers and integer amounts per order.
* ``survey_raw``      - the messy form export (headers with edge spaces, six
  course columns, currency-decorated range labels, blank app answers, junk rows).
* ``survey_defects``  - a stage-4 frame with key-derived defects for the gate.
* ``question_log`` / ``pipeline_log`` - text tables for the text jobs.

Plan shape: lineitem is pre-aggregated per order (partial aggregation before
the shuffle), orders join customer on the customer key, nation and region are
joined as fixed 25-row and 5-row dimensions (broadcast, size bounded by the
schema, not by the data), then the per-order amounts join on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import idiv

KEY = "response_id"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan one driver table, projecting only the named columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _whole(c: Column) -> Column:
    """``round(c)`` of a double as a long, halves away from zero: ``round`` goes through a decimal text for every value.

    The part that the cast cuts off is exact in doubles, and so is its comparison with a half.
    """
    rest = c - c.cast("long")
    return c.cast("long") + F.when(rest >= 0.5, 1).when(rest <= -0.5, -1).otherwise(0)


def _cents(c: Column) -> Column:
    return _whole(c * 100)


def _expense_bucket(x: Column) -> Column:
    return (F.when(x < 500, 0).when(x < 1000, 1).when(x < 2000, 2).when(x < 3000, 3)
            .when(x < 4000, 4).when(x <= 5000, 5).otherwise(6))


def _allowance_bucket(x: Column) -> Column:
    return F.when(x < 500, 0).when(x < 1500, 1).when(x <= 3000, 2).otherwise(3)


# Bucket boundaries of the survey instrument: (kind, low, high) per bucket.
EXPENSE_BUCKETS = (("lt", 500, None), ("range", 500, 1000), ("range", 1000, 2000),
                   ("range", 2000, 3000), ("range", 3000, 4000), ("range", 4000, 5000),
                   ("gt", 5000, None))
ALLOWANCE_BUCKETS = (("lt", 500, None), ("range", 500, 1500), ("range", 1500, 3000),
                     ("gt", 3000, None))


def survey_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order answers with integer amounts ``a n r q al`` (see FIXTURES C1)."""
    li = (
        read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag",
                   "l_extendedprice", "l_quantity")
        .groupBy("l_orderkey")
        .agg(*[
            idiv(F.sum(F.when(F.col("l_returnflag") == flag, _cents(F.col("l_extendedprice")))
                       .otherwise(F.lit(0).cast("long"))), F.lit(3000)).alias(alias)
            for flag, alias in (("A", "a"), ("N", "n"), ("R", "r"))
        ], (F.sum(_whole(F.col("l_quantity"))) * 25).alias("q"))
    )
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                          "c_mktsegment")
    # no hints: Spark broadcasts nation and region by their file sizes
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    base = (
        orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    k = F.col("o_orderkey")
    seg = F.col("c_mktsegment")
    degree = (F.when(seg == "BUILDING", "B.Com").when(seg == "AUTOMOBILE", "BE / B.Tech")
              .when(seg == "FURNITURE", "BSc").when(seg == "HOUSEHOLD", "MBA")
              .when(F.col("o_custkey") % 2 == 0, "ME / M.Tech").otherwise("Other"))
    pri = F.col("o_orderpriority")
    year = (F.when((degree == "MBA") & (pri == "3-MEDIUM"), "2nd Year")
            .when(pri.isin("1-URGENT", "5-LOW"), "1st Year").when(pri == "2-HIGH", "2nd Year")
            .when(pri == "3-MEDIUM", "3rd Year").otherwise("4th Year"))
    app_slot = idiv(k, F.lit(20)) % 8
    apps = ("GPay", "GPay", "PhonePe", "SBI Pay", "Amazon Pay", "BHIM UPI", "Airtel Thanks App", "Other")
    app = F.coalesce(F.get(F.array(*map(F.lit, apps)), app_slot.cast("int")), F.lit("Other"))
    rk = F.col("r_regionkey")
    return base.select(
        k.alias(KEY),
        F.col("o_orderdate"),
        F.col("c_name"),
        F.when(F.col("o_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        degree.alias("degree"),
        year.alias("year_of_study"),
        F.when(F.col("o_orderstatus") == "F", "Hostel").when(F.col("o_orderstatus") == "O", "Day Scholar")
        .otherwise("PG").alias("accommodation"),
        F.when(F.col("n_nationkey") % 2 == 0, "Rural").otherwise("Urban").alias("background"),
        F.when(idiv(k, F.lit(7)) % 5 < 2, "Yes").otherwise("No").alias("work_internship"),
        F.col("n_name"), F.col("r_name"), F.col("n_nationkey"),
        F.when(k % 20 < 8, "UPI").when(k % 20 < 13, "Cash").when(k % 20 < 17, "Debit/Credit Card")
        .otherwise("Other").alias("preferred_payment"),
        F.when(k % 11 == 0, spec.NOT_APPLICABLE).otherwise(app).alias("upi_app"),
        F.when(idiv(k, F.lit(3)) % 3 == 0, "No").otherwise("Yes").alias("track_digitally"),
        F.when(k % 7 < 4, "Yes").otherwise("No").alias("budget_plan"),
        F.when(rk == 0, "Online Learning Platforms").when(rk == 1, "Books & Study Materials")
        .when(rk == 2, "Internet & Data Packs").when(rk == 3, "Software Tools").otherwise("Other")
        .alias("study_focus"),
        *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("a", "n", "r", "q")],
        idiv(_cents(F.col("o_totalprice")), F.lit(10000)).alias("al"),
    )


_FULLWIDTH = {ord(c): 0xFF10 + i for i, c in enumerate("0123456789")} | {ord("<"): 0xFF1C, ord(">"): 0xFF1E}
_MOJIBAKE = spec.CURRENCY_ARTEFACTS[1:4]


def _label_renderings(buckets) -> list[str]:
    """The dirty texts of each bucket's label in turn, in the order of ``_label_style``."""
    out = []
    for kind, lo, hi in buckets:
        if kind == "range":
            base, compact, commas, dash, rev = f"{lo} - {hi}", f"{lo}-{hi}", f"{lo:,} - {hi:,}", f"{lo} – {hi}", f"{hi} - {lo}"
        else:
            sign = "<" if kind == "lt" else ">"
            base, compact, commas, rev = f"{sign} {lo}", f"{sign}{lo}", f"{sign} {lo:,}", None
            dash = base
        rupee = base + " ₹"
        out += [rupee, commas, "Rs. " + base, dash, f"{base} {_MOJIBAKE[0]}", "  " + compact + "INR  ", base.translate(_FULLWIDTH),
                rev if rev is not None else rupee, f"{base} {_MOJIBAKE[1]}", f"{base} {_MOJIBAKE[2]}"]
    return out


STYLES = 10


def _label_style(k: Column) -> Column:
    """Which rendering a key's labels take: ``k % 8``, and of the three mojibake forms the one of ``k / 8 % 3``."""
    turn = idiv(k, F.lit(8)) % 3
    return (F.when((k % 8).between(0, 7) & (k % 8 != 4), k % 8)
            .when(k % 8 == 4, F.when(turn == 0, 4).when(turn == 1, 8).otherwise(9)).otherwise(7)).cast("int")


def _render_label(bucket: Column, buckets, style: Column) -> Column:
    """Dirty text of a bucket label: one look into a constant list."""
    return F.get(F.array(*map(F.lit, _label_renderings(buckets))), bucket * STYLES + style)


RAW_HEADERS = {
    # raw header as exported (edge / inner spaces significant) -> amounts column
    "Residential Background ": "background",
    "Part-time Work/Internship ": "work_internship",
    "Preferred Payment  ": "preferred_payment",
}


def survey_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy stage-3 input: one row per order plus two junk rows."""
    s = survey_amounts(spark, sf_dir)
    k = F.col(KEY)
    cn = F.when((k % 50 == 0) & (F.col("n_nationkey") % 6 == 5), F.lit(1)) \
        .otherwise(F.col("n_nationkey") % 6 + 1)
    cr = F.when(k % 50 == 0, cn + 1)
    rep = F.when(k % 70 == 0, F.when((cn != 1) & (F.coalesce(cr, F.lit(0)) != 1), 1)
                 .when((cn != 2) & (F.coalesce(cr, F.lit(0)) != 2), 2).otherwise(3))
    # Lambdas over arrays keep the projection out of the joins' generated method, which had become too large to be compiled.
    courses = F.transform(F.array(*map(F.lit, range(1, len(spec.COURSE_COLUMNS) + 1))), lambda i: (
        F.when(i == F.col("_cn"), F.col("n_name"))
        .when(i == F.col("_cr"), F.col("r_name"))
        .when(i == F.col("_rep"), F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
        .when((k % 13 == 0) & (i == 6), F.lit("   "))))
    upi = F.when(k % 22 == 0, F.lit(None).cast("string")).when(k % 22 == 11, F.lit("  ")) \
        .otherwise(F.col("upi_app"))
    ts = F.date_format(F.from_utc_timestamp(F.col("o_orderdate").cast("timestamp"), spec.SOURCE_TIMEZONE),
                       "yyyy-MM-dd HH:mm:ss")
    # each row's style and buckets are columns of their own, so they are computed once
    s = s.withColumns({"_cn": cn, "_cr": cr, "_rep": rep}).withColumns({"_courses": courses, "_style": _label_style(k), **{f"_{c}": _expense_bucket(F.col(c)) for c in ("a", "n", "r", "q")}, "_al": _allowance_bucket(F.col("al"))})
    style = F.col("_style")
    rows = s.select(
        ts.alias("Timestamp"),
        F.col("c_name").alias("Student Name"),
        F.col("gender").alias("Gender"),
        F.col("degree").alias("Degree"),
        F.col("year_of_study").alias("Year of Study"),
        F.col("accommodation").alias("Accommodation Type"),
        F.col("background").alias("Residential Background "),
        F.col("work_internship").alias("Part-time Work/Internship "),
        *[F.get("_courses", F.lit(i)).alias(name) for i, name in enumerate(spec.COURSE_COLUMNS)],
        _render_label(F.col("_a"), EXPENSE_BUCKETS, style).alias("Food Expenses  (Monthly)"),
        _render_label(F.col("_n"), EXPENSE_BUCKETS, style).alias("Transport Expenses  (Monthly)"),
        _render_label(F.col("_r"), EXPENSE_BUCKETS, style).alias("Academic Expenses  (Monthly)"),
        _render_label(F.col("_q"), EXPENSE_BUCKETS, style).alias("Other Expenses (Monthly)"),
        F.col("preferred_payment").alias("Preferred Payment  "),
        upi.alias("If UPI which app you use?"),
        F.col("track_digitally").alias("Do you track your expenses digitally?"),
        _render_label(F.col("_al"), ALLOWANCE_BUCKETS, style).alias(" Monthly Allowance"),
        F.col("budget_plan").alias("Do you maintain a monthly budget plan?"),
        F.col("study_focus").alias("In which study-related areas do you spend the most each month?"),
        k.alias(KEY),
    )
    # Two corrupted trailing rows: no timestamp, blank name, everything else filled.
    junk = (
        spark.range(1, 3)
        .select(*[
            (F.lit(None).cast("string") if c == "Timestamp"
             else F.lit("  ") if c == "Student Name"
             else (-F.col("id")).alias(KEY) if c == KEY
             else F.lit("Other")).alias(c)
            for c in rows.columns
        ])
    )
    return rows.unionByName(junk)


# --------------------------------------------------------------------------- #
# Defect fixture for the quality gate (stage-4 frame with display headers)
# --------------------------------------------------------------------------- #

def survey_defects(stage4_display: DataFrame) -> DataFrame:
    """Apply the key-derived defects of FIXTURES C3, in order, on a stage-4 frame.

    The result has every display column as text (the gate reads a file of text),
    plus ``response_id``.  Derived columns are not recomputed after the defects.
    """
    k = F.col(KEY)
    df = stage4_display.select(
        *[F.col(f"`{c}`").cast("string").alias(c) if c != KEY else F.col(KEY)
          for c in stage4_display.columns]
    )

    def patch(d: DataFrame, cond: Column, column: str, value: Column) -> DataFrame:
        return d.withColumn(column, F.when(cond, value).otherwise(F.col(f"`{column}`")))

    food = F.col("Food").cast("long")
    df = patch(df, k % 97 == 0, "Food", (-food).cast("string"))
    df = patch(df, k % 89 == 0, "Degree", F.lit("Diploma"))
    df = patch(df, k % 83 == 0, "Student Name", F.lit("   "))
    df = patch(df, k % 79 == 0, "Student Name", F.lit(None).cast("string"))
    df = patch(df, k % 103 == 0, "Savings", (F.col("Savings").cast("long") + 1).cast("string"))
    df = patch(df, k % 107 == 0, "Total Expenses", (F.col("`Total Expenses`").cast("long") + 10).cast("string"))
    df = patch(df, k % 109 == 0, "Allowance", F.lit("n/a"))
    df = patch(df, k % 113 == 0, "Food", (F.col("Food").cast("double") + 0.5).cast("string"))
    df = patch(df, k % 127 == 0, "Timestamp", F.lit("not a date"))
    df = patch(df, k % 131 == 0, "Timestamp", F.regexp_replace(F.col("Timestamp"), r"^\d{4}", "2999"))
    df = patch(df, k % 139 == 0, "Budget Usage %", F.lit("20000"))
    df = patch(df, k % 149 == 0, "Total Expenses", F.lit("abc"))
    df = patch(df, k % 151 == 0, "Study Focus", F.lit(""))
    twice = df.filter(k % 101 == 0)
    return df.unionByName(twice)


# --------------------------------------------------------------------------- #
# Text fixtures
# --------------------------------------------------------------------------- #

def pipeline_log(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    """One log line per ``events`` row, template chosen by ``event_id % len(templates)``."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    arr = F.array(*[F.lit(t) for t in templates])
    idx = (F.col("event_id") % len(templates)).cast("int")
    line = F.format_string("[%s] user=%d %s", F.col("event_type"), F.col("user_id"),
                           F.element_at(arr, idx + 1))
    return ev.select(F.col("event_id").alias("line_id"), F.col("ts"), line.alias("line"))


def question_log(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    """User turns of ``conversations`` mapped onto question templates by ``(conv_id*7+turn) % n``."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    arr = F.array(*[F.lit(t) for t in templates])
    idx = ((F.col("conv_id") * 7 + F.col("turn")) % len(templates)).cast("int")
    return conv.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.element_at(arr, idx + 1).alias("question"))


def _inside(text: Column, phrase: Column, place: Column) -> Column:
    """``text`` with ``phrase`` put between two of its words (cut at single spaces), at ``place`` modulo their number."""
    words = F.split(F.coalesce(text, F.lit("")), " ", -1)
    at = (place % (F.size(words) + 1)).cast("int")
    return F.array_join(F.concat(F.slice(words, 1, at), F.array(phrase), F.slice(words, at + 1, F.size(words))), " ")


def mixed_questions(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    """User turns of ``conversations``: their own text with the question of ``question_log`` at a hashed place inside."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    arr = F.array(*[F.lit(t) for t in templates])
    idx = ((F.col("conv_id") * 7 + F.col("turn")) % len(templates)).cast("int")
    return conv.filter(F.col("role") == "user").select(
        "conv_id", "turn", _inside(F.col("text"), F.element_at(arr, idx + 1), F.col("conv_id") * 31 + F.col("turn") * 17).alias("question"))


def mixed_log(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    """Turns of ``conversations`` as log lines; every third holds a log message at a hashed place inside its text."""
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    key = F.col("conv_id") * 7 + F.col("turn")
    arr = F.array(*[F.lit(t) for t in templates])
    message = F.element_at(arr, (key % len(templates)).cast("int") + 1)
    line = F.when(key % 3 == 0, _inside(F.col("text"), message, F.col("conv_id") * 31 + F.col("turn") * 17)).otherwise(F.col("text"))
    return conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("line_id"),
                       (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("turn"))).alias("ts"), line.alias("line"))


def money_defects(stage3: DataFrame) -> DataFrame:
    """Stage-3 frame with unparseable money labels: free text, a bare number, a missing answer."""
    k = F.col(KEY)
    return stage3.withColumns({
        "food_expenses_monthly": F.when(k % 37 == 0, F.lit("about 2k")).otherwise(F.col("food_expenses_monthly")),
        "transport_expenses_monthly": F.when(k % 41 == 0, F.lit("1500"))
        .otherwise(F.col("transport_expenses_monthly")),
        "monthly_allowance": F.when(k % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("monthly_allowance")),
    })
