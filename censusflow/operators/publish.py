"""Stages 5-6: pre-load rules, publish projection, post-load verification, reject split.

The pre-load rules read the stage-4 file the way the loader does: every column
as text, blanks as ``''`` (never NULL).  All counting rules over the data are
one fused aggregation; domain offenders are an exact distinct count over the
offending rows only; the column-set rule looks at the schema on the driver.
Every rule returns a small DataFrame of problems: ``rule, column, offending``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import col_of, count_if, is_blank, numeric
from ..plans.view import publish_projection  # noqa: F401  (L8 lives with the view)

PROBLEM_COLUMNS = ("rule", "column", "offending")


def loader_frame(df: DataFrame, key: str = "response_id") -> DataFrame:
    """Text-only reading of a stage-4 frame: NULL becomes '' (blanks are data, not NA)."""
    return df.select(*[(F.coalesce(col_of(c).cast("string"), F.lit("")) if c != key else col_of(c)).alias(c)
                       for c in df.columns])


def preload_columns(df: DataFrame, expected=spec.DISPLAY_COLUMNS, key: str = "response_id") -> list[tuple[str, str]]:
    """L1: missing columns stop the load; extra and reordered columns are reported."""
    cols = [c for c in df.columns if c != key]
    missing = [c for c in expected if c not in cols]
    if missing:
        return [("missing", ", ".join(missing))]
    out = []
    extra = [c for c in cols if c not in expected]
    if extra:
        out.append(("extra", ", ".join(extra)))
    if [c for c in cols if c in expected] != list(expected):
        out.append(("reordered", ", ".join(c for c in cols if c in expected)))
    return out


def _problems(agg: DataFrame, items: list[tuple[str, str, str]]) -> DataFrame:
    """Stack (rule, column, agg-column) triples and keep the ones with offending rows."""
    structs = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(k).cast("long").alias("offending"))
               for r, c, k in items]
    return (agg.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
            .filter(F.col("offending") > 0))


def preload_blanks(df: DataFrame, columns=spec.DISPLAY_COLUMNS) -> DataFrame:
    """L2: blank (whitespace-only) cells per column."""
    present = [c for c in columns if c in df.columns]
    agg = df.agg(*[count_if(is_blank(col_of(c))).alias(f"b{i}") for i, c in enumerate(present)])
    return _problems(agg, [("blank", c, f"b{i}") for i, c in enumerate(present)])


def preload_domains(df: DataFrame, domains=None) -> DataFrame:
    """L3: number of distinct values outside each closed domain (offending rows only are shuffled)."""
    domains = spec.DOMAINS if domains is None else domains
    present = [(c, allowed) for c, allowed in domains.items() if c in df.columns]
    pairs = F.array(*[F.when(~col_of(c).isin(*allowed), F.struct(F.lit(c).alias("column"),
                                                                 col_of(c).alias("value")))
                      for c, allowed in present])
    bad = df.select(F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("b")).select("b.*").distinct()
    return bad.groupBy("column").agg(F.count(F.lit(1)).alias("offending")) \
        .select(F.lit("domain").alias("rule"), "column", "offending")


def preload_money(df: DataFrame, columns=spec.NON_NEGATIVE_HEADERS) -> DataFrame:
    """L4: non-numeric text first; a column with none is then checked for negatives."""
    present = [c for c in columns if c in df.columns]
    aggs = []
    for i, c in enumerate(present):
        v = numeric(col_of(c))
        aggs += [count_if(v.isNull() & ~is_blank(col_of(c))).alias(f"u{i}"), count_if(v < 0).alias(f"n{i}")]
    agg = df.agg(*aggs)
    structs = []
    for i, c in enumerate(present):
        u, n = F.col(f"u{i}"), F.col(f"n{i}")
        structs.append(F.struct(F.when(u > 0, F.lit("non_numeric")).otherwise(F.lit("negative")).alias("rule"),
                                F.lit(c).alias("column"),
                                F.when(u > 0, u).otherwise(n).cast("long").alias("offending")))
    return (agg.select(F.explode(F.array(*structs)).alias("p")).select("p.*")
            .filter(F.col("offending") > 0))


def preload_usage(df: DataFrame, column: str = "Budget Usage %") -> DataFrame:
    """Any non-numeric usage is reported; otherwise values outside 0..10000."""
    v = numeric(col_of(column))
    agg = df.agg(count_if(v.isNull()).alias("u"),
                 count_if((v < spec.BUDGET_USAGE_MIN) | (v > spec.BUDGET_USAGE_MAX)).alias("o"))
    return agg.select(
        F.when(F.col("u") > 0, F.lit("non_numeric")).otherwise(F.lit("out_of_range")).alias("rule"),
        F.lit(column).alias("column"),
        F.when(F.col("u") > 0, F.col("u")).otherwise(F.col("o")).cast("long").alias("offending"),
    ).filter(F.col("offending") > 0)


def preload_name(df: DataFrame, column: str = "Student Name") -> DataFrame:
    """Blank names (the table's name-not-blank constraint)."""
    agg = df.agg(count_if(is_blank(col_of(column))).alias("b"))
    return _problems(agg, [("name_blank", column, "b")])


def preload_arithmetic(df: DataFrame) -> DataFrame:
    """Stored total / savings against their components (|diff| > 0.005).

    Skipped entirely (no rows) when any component anywhere is unparseable, as the
    rule cannot be evaluated on such a frame; decided inside the same aggregation.
    """
    comps = ["Food", "Transport", "Academic", "Other"]
    vals = {c: numeric(col_of(c)) for c in comps + ["Allowance", "Total Expenses", "Savings"]}
    exp_total = vals["Food"] + vals["Transport"] + vals["Academic"] + vals["Other"]
    exp_sav = vals["Allowance"] - exp_total
    agg = df.agg(
        count_if(F.greatest(*[vals[c].isNull() for c in comps + ["Allowance"]])).alias("unparseable"),
        count_if(F.abs(vals["Total Expenses"] - exp_total) > spec.RECONCILE_TOLERANCE).alias("t"),
        count_if(F.abs(vals["Savings"] - exp_sav) > spec.RECONCILE_TOLERANCE).alias("s"),
    )
    return _arith_rows(agg)


def _arith_rows(agg: DataFrame) -> DataFrame:
    items = [("derived_mismatch", "Total Expenses", "t"), ("derived_mismatch", "Savings", "s")]
    structs = [F.when(F.col("unparseable") == 0,
                      F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column"), F.col(k).cast("long").alias("offending")))
               for r, c, k in items]
    return (agg.select(F.explode(F.array(*structs)).alias("p")).filter(F.col("p").isNotNull()).select("p.*")
            .filter(F.col("offending") > 0))


def problem_examples(df: DataFrame, domains=None, columns=spec.DISPLAY_COLUMNS, key: str = "response_id") -> DataFrame:
    """L2, L3: at most five examples for each blank or domain problem: rule, column, examples.

    Keys of rows with a blank cell; distinct values outside a domain.  ``row_number`` keeps five per
    problem, which Spark does before the shuffle as well.
    """
    domains = spec.DOMAINS if domains is None else domains
    blank = [F.when(is_blank(col_of(c)), F.struct(F.lit("blank").alias("rule"), F.lit(c).alias("column"), col_of(key).cast("string").alias("value")))
             for c in columns if c in df.columns]
    outside = [F.when(~col_of(c).isin(*allowed), F.struct(F.lit("domain").alias("rule"), F.lit(c).alias("column"), col_of(c).cast("string").alias("value")))
               for c, allowed in domains.items() if c in df.columns]
    found = df.select(F.explode(F.filter(F.array(*blank, *outside), lambda x: x.isNotNull())).alias("p")).select("p.*").distinct()
    first = Window.partitionBy("rule", "column").orderBy(F.length("value"), "value")
    top = found.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= spec.MAX_EXAMPLES)
    return top.groupBy("rule", "column").agg(F.array_sort(F.collect_list("value")).alias("examples"))


def verify_load(published: DataFrame, expected: dict | None = None) -> DataFrame:
    """The six post-load checks as data, from ONE aggregation, stacked into rows."""
    e = dict(spec.SEED_EXPECTATIONS, **(expected or {}))
    u, s, t = F.col("budget_usage_pct").cast("double"), F.col("savings").cast("double"), \
        F.col("total_expenses").cast("double")
    gen = (F.col("total_expenses") != F.col("food_expenses") + F.col("transport_expenses")
           + F.col("academic_expenses") + F.col("other_expenses")) \
        | (F.col("savings") != F.col("allowance") - F.col("total_expenses"))
    a = published.agg(F.count(F.lit(1)).alias("n"), F.min(u).alias("u0"), F.max(u).alias("u1"),
                      F.min(s).alias("s0"), F.max(s).alias("s1"), F.min(t).alias("t0"), F.max(t).alias("t1"),
                      count_if(F.col("savings") >= 0).alias("pos"), count_if(gen).alias("gen"))

    def row(name: str, ok: Column, lo: Column | None, hi: Column | None) -> Column:
        return F.struct(F.lit(name).alias("name"), ok.alias("ok"),
                        (lo if lo is not None else F.lit(None)).cast("double").alias("observed_low"),
                        (hi if hi is not None else F.lit(None)).cast("double").alias("observed_high"))
    c = F.col
    rows = [
        row("row_count", c("n") == e["row_count"], c("n"), None),
        row("budget_usage_pct_range", (c("u0") == e["usage_range"][0]) & (c("u1") == e["usage_range"][1]), c("u0"), c("u1")),
        row("savings_range", (c("s0") == e["savings_range"][0]) & (c("s1") == e["savings_range"][1]), c("s0"), c("s1")),
        row("total_expenses_range", (c("t0") == e["total_range"][0]) & (c("t1") == e["total_range"][1]), c("t0"), c("t1")),
        row("no_positive_savings", c("pos") == 0, c("pos"), None),
        row("generated_columns_consistent", c("gen") == 0, c("gen"), None),
    ]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*") \
        .withColumn("ok", F.coalesce(F.col("ok"), F.lit(False)))


def constraint_violations(stage4_text: DataFrame, key: str = "response_id") -> DataFrame:
    """Row-level reject split; each rejected row lists the table constraints it breaks.

    The target table rejects a whole load on the first violation; splitting per
    row keeps the good rows loadable and names every reason for the rest.
    """
    return checked_rows(stage4_text, key).filter(F.col("violations") != "")


def checked_rows(stage4_text: DataFrame, key: str = "response_id") -> DataFrame:
    """L10 for a split without a join: ``key`` and ``violations`` (comma-joined, '' if none) of every row."""
    numbers = [*spec.NON_NEGATIVE_HEADERS, "Budget Usage %"]
    read = stage4_text.withColumns({f"__number_{i}": numeric(col_of(c)) for i, c in enumerate(numbers)})
    value = {c: F.col(f"__number_{i}") for i, c in enumerate(numbers)}
    checks: list[tuple[str, Column]] = []
    for header, allowed in spec.DOMAINS.items():
        col = spec.PUBLISHED_NAMES[header]
        checks.append((f"ck_students_budget_{col}", ~F.coalesce(col_of(header).isin(*allowed), F.lit(False))))
    for header in spec.NON_NEGATIVE_HEADERS:
        col = spec.PUBLISHED_NAMES[header]
        v = value[header]
        checks.append((f"nn_{col}", v.isNull()))
        checks.append((f"ck_students_budget_{'allowance' if col == 'allowance' else col.split('_')[0]}_non_negative",
                       F.coalesce(v < 0, F.lit(False))))
    u = value["Budget Usage %"]
    checks.append(("nn_budget_usage_pct", u.isNull()))
    checks.append(("ck_students_budget_usage_range",
                   F.coalesce((u < spec.BUDGET_USAGE_MIN) | (u > spec.BUDGET_USAGE_MAX), F.lit(False))))
    checks.append(("ck_students_budget_name_not_blank", is_blank(col_of("Student Name"))))
    violated = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in checks])
    return read.select(col_of(key).alias(key), violated.alias("violations"))
