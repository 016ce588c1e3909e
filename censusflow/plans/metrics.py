"""Allowlisted metric layer: measure x aggregation x dimensions x filters -> DataFrame.

Every name is validated against the spec below before a plan is built, and
values are compared as literals, so no user text ever reaches SQL.  Results
are named ``<aggregation>_<measure>`` (``students`` for counts).

Exactness: averages are ``sum / count`` divided once in double precision, the
usage ratio is summed in exact tenths, medians are discrete (an observed value).
Grouped results sort by the value in the ranking direction with the group keys
as tiebreak; listings break ties on ``student_id``, so ``limit`` is deterministic.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import count_if, median_disc, round_half_up_ratio
from .view import year_ordinal

DEFAULT_LIMIT = 50
MAX_LIMIT = 500
CENSORED = spec.CENSORED_EXPENSE


EXPENSES = ("food_expenses", "transport_expenses", "academic_expenses", "other_expenses")


class Measure(NamedTuple):
    """What can be asked for. A head count has no amount: only rows are counted."""
    name: str    # allowlist key
    column: str  # view column

    @property
    def counts_rows(self) -> bool:
        return self.column == "student_id"


MEASURES: dict[str, Measure] = {
    **{c: Measure(c, c) for c in ("total_expenses", "allowance", "overspend_amount", "budget_usage_pct", "savings", *EXPENSES)},
    "student_count": Measure("student_count", "student_id")}

# dimension -> closed domain; None is free text: groupable, never filtered
DIMENSIONS: dict[str, tuple[str, ...] | None] = {
    **{spec.PUBLISHED_NAMES[h]: tuple(values) for h, values in spec.DOMAINS.items()},
    "study_focus": ("Online Learning Platforms", "Books & Study Materials", "Internet & Data Packs", "Software Tools", "Other"),
    "specialization": None}

AGGREGATIONS = ("avg", "sum", "count", "max", "min", "median")


class MetricError(ValueError):
    """A request outside the allowlist (refused, never guessed)."""


def _measure(name: str) -> Measure:
    m = MEASURES.get(name)
    if m is None:
        raise MetricError(f"unknown measure {name!r}")
    return m


def _dimension(name: str) -> str:
    if name not in DIMENSIONS:
        raise MetricError(f"unknown dimension {name!r}")
    return name


def _check_value(dim: str, value: str) -> None:
    domain = DIMENSIONS[dim]
    if domain is None:
        raise MetricError(f"dimension {dim!r} is free text and cannot be filtered")
    if value not in domain:
        raise MetricError(f"value {value!r} is not in the domain of {dim!r}")


def clamp_limit(limit: int | None) -> int:
    """Limit clamped to 1..500, default 50."""
    if limit is None:
        return DEFAULT_LIMIT
    return max(1, min(int(limit), MAX_LIMIT))


def _usage10() -> Column:
    return F.round(F.col("budget_usage_pct") * 10).cast("long")


def aggregate(agg: str, m: Measure) -> Column:
    """M3: one aggregate over a measure; exact sums, one division for means."""
    if agg not in AGGREGATIONS:
        raise MetricError(f"unknown aggregation {agg!r}")
    if agg == "count" or m.counts_rows:
        return F.count(F.lit(1))
    c = m.column
    if c == "budget_usage_pct":
        if agg == "avg":
            return F.sum(_usage10()).cast("double") / (F.count(_usage10()) * 10).cast("double")
        if agg == "sum":
            return F.sum(_usage10()).cast("double") / F.lit(10.0)
    if agg == "avg":
        return F.sum(c).cast("double") / F.count(c).cast("double")
    if agg == "sum":
        return F.sum(c).cast("long")
    if agg == "max":
        return F.max(c)
    if agg == "min":
        return F.min(c)
    return median_disc(c)


def value_name(agg: str, m: Measure) -> str:
    return "students" if (agg == "count" or m.counts_rows) else f"{agg}_{m.name}"


def _where(df: DataFrame, filters, compare) -> DataFrame:
    """M4/M5: equality or negated filters ANDed; ``<>`` drops NULLs (SQL rule)."""
    for dim, value, *neg in filters:
        d = _dimension(dim)
        _check_value(d, value)
        cond = (F.col(d) != value) if (neg and neg[0]) else (F.col(d) == value)
        df = df.filter(cond)
    if compare is not None:
        dim, values = compare
        d = _dimension(dim)
        for v in values:
            _check_value(d, v)
        df = df.filter(F.col(d).isin(*values))
    return df


def metric_query(view: DataFrame, measure: str = "student_count", agg: str | None = None,
                 dimensions=(), filters=(), compare=None, ranking: str = "desc",
                 limit: int | None = DEFAULT_LIMIT, detail: bool = False,
                 extreme: bool = False) -> DataFrame:
    """Build the DataFrame for one allowlisted metric request."""
    m = _measure(measure)
    agg = agg or ("count" if m.counts_rows else "avg")
    if ranking not in ("asc", "desc"):
        raise MetricError(f"unknown ranking {ranking!r}")
    dims = [_dimension(d) for d in dimensions]
    if compare is not None and compare[0] not in dims:
        dims = dims + [_dimension(compare[0])]
    lim = clamp_limit(limit)
    df = _where(view, filters, compare)
    desc = ranking == "desc"

    def order(c: str) -> Column:
        return F.desc(c) if desc else F.asc(c)

    if detail:  # M12: per-student listing
        col = "total_expenses" if m.column == "student_id" else m.column
        cols = ["student_name", "degree", "year_of_study", "total_expenses"]
        if col not in cols:
            cols.append(col)
        return df.orderBy(order(col), "student_id").limit(lim).select(*cols)
    if not dims and (agg == "count" or m.counts_rows):  # M6: bare count
        return df.agg(F.count(F.lit(1)).alias("students"))
    if extreme:  # M11: the extreme row itself
        cols = ["student_name", "degree", "year_of_study", "accommodation", m.column]
        return df.orderBy(order(m.column), "student_id").limit(1).select(*cols)
    name = value_name(agg, m)
    value = aggregate(agg, m).alias(name)
    if not dims:  # M6: scalar aggregate
        return df.agg(value)
    extra = []
    if m.column == "budget_usage_pct":  # M9: aggregate ratio beside the mean of ratios
        extra.append(round_half_up_ratio(F.sum("total_expenses") * 100, F.sum("allowance"), 2)
                     .alias("aggregate_utilisation_pct"))
    g = df.groupBy(*dims).agg(value, *extra)
    if len(dims) == 1 and dims[0] == "year_of_study":  # M8: ordinal order
        g = g.orderBy(year_ordinal(F.col("year_of_study")).asc_nulls_last(), "year_of_study")
    else:  # M7: value order, group keys as tiebreak
        g = g.orderBy(order(name), *dims)
    return g.limit(lim)


def top_n(view: DataFrame, dimension: str, n: int = 5, filters=()) -> DataFrame:
    """The N most frequent values of a dimension."""
    d = _dimension(dimension)
    df = _where(view, filters, None)
    return (df.groupBy(d).agg(F.count(F.lit(1)).alias("students"))
            .orderBy(F.desc("students"), d).limit(clamp_limit(n)))


def drift_check(view: DataFrame, expected_rows: int = 213, expected_means=None,
                tolerance: float = 0.01) -> DataFrame:
    """One aggregation compared with the recorded facts (parameters)."""
    means = expected_means or {"total_expenses": 11461.27, "allowance": 1578.64}
    cells = sum((count_if(F.col(c) == CENSORED) for c in EXPENSES), F.lit(0))
    a = view.agg(F.count(F.lit(1)).alias("row_count"),
                 *[round_half_up_ratio(F.sum(c), F.count(c), 2).alias(f"mean_{c}") for c in means],
                 cells.alias("censored_cells"))
    return a.select(
        "row_count", (F.col("row_count") == expected_rows).alias("row_count_ok"),
        *[F.col(f"mean_{c}") for c in means],
        *[(F.abs(F.col(f"mean_{c}") - e) <= tolerance).alias(f"mean_{c}_ok") for c, e in means.items()],
        "censored_cells", (F.col("censored_cells") > 0).alias("censored_cells_ok"),
    )


def group_spread(grouped: DataFrame, key: str, value: str) -> DataFrame:
    """Top / bottom group, their ratio and a verdict (>=1.5 wide, <1.15 flat)."""
    g = grouped.filter(F.col(value).isNotNull())
    a = g.agg(F.count(F.lit(1)).alias("groups"),
              F.max_by(F.col(key), F.struct(F.col(value), F.col(key))).alias("top_group"),
              F.max(value).cast("double").alias("top_value"),
              F.min_by(F.col(key), F.struct(F.col(value), F.col(key))).alias("low_group"),
              F.min(value).cast("double").alias("low_value"))
    ratio = F.when(F.col("low_value") != 0, F.col("top_value") / F.col("low_value"))
    return a.select(
        "groups", "top_group", "top_value", "low_group", "low_value",
        ratio.alias("spread_ratio"),
        F.when(ratio >= 1.5, "wide").when(ratio < 1.15, "flat").otherwise("moderate").alias("verdict"),
    )


def share_of_rows(view: DataFrame, filters=()) -> DataFrame:
    """A filtered count as a share of all rows (one pass, conditional count)."""
    cond = F.lit(True)
    for dim, value, *neg in filters:
        d = _dimension(dim)
        _check_value(d, value)
        cond = cond & ((F.col(d) != value) if (neg and neg[0]) else (F.col(d) == value))
    a = view.agg(count_if(cond).alias("students"), F.count(F.lit(1)).alias("all_students"))
    return a.select("students", "all_students",
                    round_half_up_ratio(F.col("students") * 100, F.col("all_students"), 1).alias("share_pct"))


def savings_reading(view: DataFrame) -> DataFrame:
    """Share of savers; when nobody saves the deficit is the answer instead."""
    a = view.agg(F.count(F.lit(1)).alias("students"),
                 count_if(F.col("savings") >= 0).alias("savers"),
                 F.sum("overspend_amount").alias("_d"), F.count("overspend_amount").alias("_n"))
    return a.select(
        "students", "savers",
        round_half_up_ratio(F.col("savers") * 100, F.col("students"), 1).alias("savers_pct"),
        (F.col("savers") == 0).alias("no_savers"),
        round_half_up_ratio(F.col("_d"), F.col("_n"), 2).alias("avg_deficit"),
    )


def overview(view: DataFrame) -> DataFrame:
    """Dataset overview in one row."""
    cens = sum((count_if(F.col(c) == CENSORED) for c in EXPENSES), F.lit(0))
    return view.agg(
        F.count(F.lit(1)).alias("students"),
        round_half_up_ratio(F.sum("total_expenses"), F.count("total_expenses"), 2).alias("avg_total_expenses"),
        round_half_up_ratio(F.sum("allowance"), F.count("allowance"), 2).alias("avg_allowance"),
        round_half_up_ratio(F.sum(_usage10()), F.count(_usage10()) * 10, 2).alias("mean_of_ratios_pct"),
        round_half_up_ratio(F.sum("total_expenses") * 100, F.sum("allowance"), 2).alias("aggregate_utilisation_pct"),
        round_half_up_ratio(cens * 100, F.count(F.lit(1)) * 4, 1).alias("censored_cells_pct"),
    )


def _caveats() -> list[tuple[str, str, Column]]:
    """(measure, caveat, the rows it concerns). Each measure has its own; a head count has none."""
    open_top = "the top answer has no upper end: its midpoint is a floor, so means and totals are too low"
    c = F.col
    top = F.lit(False)
    for e in EXPENSES:
        top = top | F.coalesce(c(e) == CENSORED, F.lit(False))
    return [("total_expenses", open_top, top), *[(e, open_top, c(e) == CENSORED) for e in EXPENSES],
            ("allowance", "its answers are coarser and lower than those on expenses", c("allowance") < c("total_expenses")),
            ("overspend_amount", "above zero means more spent than received", c("overspend_amount") > 0),
            ("budget_usage_pct", "a ratio, not a share: the mean of ratios differs from the ratio of the sums", c("budget_usage_pct") > 100),
            ("savings", "below zero where expenses exceed the allowance: a ranking of savers then says little", c("savings") < 0)]


def measure_caveats(view: DataFrame) -> DataFrame:
    """M1: what to keep in mind about each measure, and how far it holds in these rows, from one aggregation.

    ``measure, caveat, affected, answered, share_pct, applies``: rows concerned, rows with a value, their share (one
    decimal, null without values) and whether any row is concerned. Nulls are in neither count.
    """
    notes = _caveats()
    a = view.agg(*[count_if(cond).alias(f"a{i}") for i, (_, _, cond) in enumerate(notes)],
                 *[F.count(MEASURES[m].column).alias(f"n{i}") for i, (m, _, _) in enumerate(notes)])
    rows = [F.struct(F.lit(m).alias("measure"), F.lit(text).alias("caveat"), F.col(f"a{i}").alias("affected"), F.col(f"n{i}").alias("answered"),
                     round_half_up_ratio(F.col(f"a{i}") * 100, F.col(f"n{i}"), 1).alias("share_pct"), (F.col(f"a{i}") > 0).alias("applies"))
            for i, (m, text, _) in enumerate(notes)]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
