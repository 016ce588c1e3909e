"""Many questions, one job: a table of parsed intents answered from the published table.

Equal requests are one intent. Every aggregate intent needs the cells of one set of dimensions: those that it groups by and
those that it filters. The distinct sets are planned together: the table is aggregated once to the finest cells
that any intent needs, and the sets are rolled up from those cells by grouping sets. Intents join the cells of their set,
keep those that their filters allow and add them up. Medians come from value counts that are rolled up the same way.
Listings come from the first ``MAX_LIMIT`` rows of each finest cell in each order that is asked for: the first
rows of any union of cells are among them.

The driver sees the distinct sets of dimensions (at most 2**12) and the distinct orders (two for each measure).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import round_half_up_ratio
from ..sources.artifacts import written
from .metrics import DIMENSIONS, MAX_LIMIT, MEASURES
from .view import year_ordinal

_FILTERS = "array<struct<dim:string,test:string,values:array<string>>>"
_TENTHS = "budget_usage_pct"
ANSWER_COLUMNS = ("kind", "rank", "groups", "value_name", "value", "aggregate_utilisation_pct", "student_name", "degree", "year_of_study", "accommodation")


def _text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.coalesce(v, F.lit(""))), "|")


def plan_intents(intents: DataFrame, keys) -> DataFrame:
    """(keys, id, kind, measure, agg, dims, filters, ranking, row_limit, cell) of every intent that is not refused.

    A request without a measure is a count of the rows that its filters allow. ``cell``: the dimensions it needs.
    """
    no_dims = F.array().cast("array<string>")
    dims = F.coalesce(F.array_distinct(F.concat("dimensions", F.when(F.col("compare_dim").isNotNull(), F.array("compare_dim")).otherwise(no_dims))), no_dims)
    counts = F.col("measure").isNull() | (F.col("measure") == "student_count") | (F.col("aggregation") == "count")
    kind = (F.when(F.col("detail"), "listing").when(F.col("extreme"), "extreme").when(F.col("measure").isNull() | (counts & (F.size(dims) == 0)), "count")
            .when(F.size(dims) == 0, "scalar").otherwise("group"))
    tests = F.transform(F.coalesce("filters", F.array().cast("array<struct<dim:string,value:string,negated:boolean>>")), lambda f: F.struct(
        f["dim"].alias("dim"), F.when(f["negated"], "!=").otherwise("=").alias("test"), F.array(f["value"]).alias("values")))
    among = F.when(F.col("compare_dim").isNotNull(), F.array(F.struct(F.col("compare_dim").alias("dim"), F.lit("in").alias("test"), F.col("compare_values").alias("values"))))
    filters = F.array_sort(F.array_distinct(F.concat(tests.cast(_FILTERS), F.coalesce(among.cast(_FILTERS), F.array().cast(_FILTERS)))))
    p = intents.filter(~F.col("refused")).select(
        *keys, kind.alias("kind"), F.coalesce("measure", F.lit("student_count")).alias("measure"),
        F.when(counts, "count").otherwise(F.coalesce("aggregation", F.lit("avg"))).alias("agg"), dims.alias("dims"), filters.alias("filters"),
        F.coalesce("ranking", F.lit("desc")).alias("ranking"), F.col("row_limit").cast("int").alias("row_limit"))
    grouped = F.col("kind") == "group"
    p = p.withColumns({"dims": F.when(grouped, F.col("dims")).otherwise(no_dims), "row_limit": F.when(grouped | (F.col("kind") == "listing"), F.col("row_limit")).otherwise(1)})
    p = p.withColumn("cell", F.array_sort(F.array_distinct(F.concat("dims", F.transform("filters", lambda f: f["dim"])))))
    return p.withColumn("id", F.sha2(F.to_json(F.struct("kind", "measure", "agg", "dims", "filters", "ranking", "row_limit")), 256))


def _gid(used: list[str]) -> Column:
    """What ``grouping_id`` gives for the cells of an intent's set."""
    out = F.lit(0)
    for i, dim in enumerate(used):
        out = out + F.when(F.array_contains("cell", dim), 0).otherwise(1 << (len(used) - 1 - i))
    return out.cast("long")


def _cell_map(used: list[str]) -> Column:
    if not used:
        return F.lit(None).cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(d) for d in used]), F.array(*[F.col(d) for d in used]))


def _allowed(cell: Column) -> Column:
    """Whether a cell passes an intent's filters; a null passes none of them."""
    def test(f: Column) -> Column:
        v = F.element_at(cell, f["dim"])
        return F.coalesce(F.when(f["test"] == "!=", ~F.array_contains(f["values"], v)).otherwise(F.array_contains(f["values"], v)), F.lit(False))
    return F.forall("filters", test)


def _rolled(finest: DataFrame, used: list[str], sets: list[list[str]], extra: list[str], *aggs: Column) -> DataFrame:
    """Cells of every set: (gid, cell_of, extra, aggregates), rolled up from the finest ones."""
    if not used:
        return finest.groupBy(*extra).agg(*aggs).withColumns({"gid": F.lit(0).cast("long"), "cell_of": _cell_map(used)})
    names = [*used, *extra]
    out = finest.groupingSets([[F.col(c) for c in [*s, *extra]] for s in sets], *[F.col(c) for c in names]).agg(*aggs, F.grouping_id().alias("_gid"))
    # extra columns are in every set: their bits are the lowest ones, and 0
    return out.withColumns({"gid": F.shiftright("_gid", len(extra)).cast("long"), "cell_of": _cell_map(used)}).drop(*used, "_gid")


def _number(name: str) -> Column:
    """A measure as an exact integer: tenths of the usage, whole rupees of the rest."""
    c = F.col(MEASURES[name].column)
    return (F.round(c * 10) if name == _TENTHS else c).cast("long")


def _unit(name: Column) -> Column:
    return F.when(name == _TENTHS, F.lit(10.0)).otherwise(F.lit(1.0))


def _aggregates(distinct: DataFrame, view: DataFrame, sets: list[list[str]]) -> DataFrame:
    """(id, gvals, value, n, ratio) of the count, scalar and group intents."""
    used = sorted({d for s in sets for d in s})
    amounts = [m for m in MEASURES if m != "student_count"]
    stat = lambda m, f: f(_number(m)).alias(f"{f.__name__}_{m}")
    finest = written(view.groupBy(*used).agg(F.count("*").alias("rows"), *[stat(m, f) for m in amounts for f in (F.sum, F.count, F.min, F.max)]), "answer-cells")
    again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    cube = _rolled(finest, used, sets, [], F.sum("rows").alias("rows"), *[again[k](f"{k}_{m}").alias(f"{k}_{m}") for m in amounts for k in again])
    stats = F.array(*[F.struct(*[F.col(f"{k}_{m}").cast("decimal(38,0)").alias(k) for k in again]) for m in amounts])
    cube = cube.select("gid", "cell_of", "rows", F.col("sum_total_expenses").alias("spent"), F.col("sum_allowance").alias("given"), stats.alias("stats"))
    asked = distinct.withColumn("gid", _gid(used))
    mine = F.try_element_at("stats", F.nullif(F.array_position(F.array(*[F.lit(m) for m in amounts]), F.col("measure")).cast("int"), F.lit(0)))
    hit = asked.join(cube, "gid").filter(_allowed(F.col("cell_of")))
    hit = hit.select("id", "kind", "measure", "agg", "rows", "spent", "given", mine.alias("s"), F.transform("dims", lambda d: F.element_at("cell_of", d)).alias("gvals"))
    total = hit.groupBy("id", "gvals").agg(
        F.first("measure").alias("measure"), F.first("agg").alias("agg"), F.sum("rows").alias("n"), F.sum("s.sum").alias("sum"), F.sum("s.count").alias("count"),
        F.min("s.min").alias("min"), F.max("s.max").alias("max"), F.sum("spent").alias("spent"), F.sum("given").alias("given"))
    d = lambda c: F.col(c).cast("double")
    unit = _unit(F.col("measure"))
    value = (F.when(F.col("agg") == "count", d("n")).when(F.col("agg") == "avg", F.when(F.col("count") > 0, d("sum") / (d("count") * unit)))
             .when(F.col("agg") == "sum", d("sum") / unit).when(F.col("agg") == "min", d("min") / unit).when(F.col("agg") == "max", d("max") / unit))
    return total.select("id", "gvals", value.alias("value"), round_half_up_ratio(F.col("spent") * 100, F.col("given"), 2).alias("ratio"))


def _medians(distinct: DataFrame, view: DataFrame, sets: list[list[str]], measures: list[str]) -> DataFrame:
    """(id, gvals, median) of the median intents: the smallest value that half of the rows don't exceed."""
    used = sorted({d for s in sets for d in s})
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), _number(m).alias("v")) for m in measures])).alias("x")
    finest = written(view.select(*used, values).select(*used, "x.measure", "x.v").filter("v is not null").groupBy(*used, "measure", "v").agg(F.count("*").alias("k")), "answer-values")
    cube = _rolled(finest, used, sets, ["measure", "v"], F.sum("k").alias("k"))
    hit = distinct.withColumn("gid", _gid(used)).join(cube, ["gid", "measure"]).filter(_allowed(F.col("cell_of")))
    counts = hit.groupBy("id", "measure", F.transform("dims", lambda d: F.element_at("cell_of", d)).alias("gvals"), "v").agg(F.sum("k").alias("k"))
    w = Window.partitionBy("id", "gvals")
    ranked = counts.withColumns({"upto": F.sum("k").over(w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("k").over(w)})
    return ranked.filter("2 * upto >= all").groupBy("id", "gvals", "measure").agg(F.min("v").alias("v")).select("id", "gvals", (F.col("v").cast("double") / _unit(F.col("measure"))).alias("median"))


def _listings(distinct: DataFrame, view: DataFrame, used: list[str], orders: list[tuple[str, str]]) -> DataFrame:
    """(id, rank, value and the student's columns) of the listing and extreme intents."""
    def sort_key(column: str, ranking: str) -> Column:
        v = F.col(column).cast("double")
        return F.struct(F.lit(column).alias("column"), F.lit(ranking).alias("ranking"), v.alias("value"),
                        (F.when(v.isNull(), 1).otherwise(0) if ranking == "desc" else F.when(v.isNull(), 0).otherwise(1)).alias("nulls"), (-v if ranking == "desc" else v).alias("by"))

    shown = ["student_id", "student_name", "degree", "year_of_study", "accommodation"]
    rows = view.select(*shown, *[c for c in used if c not in shown], F.explode(F.array(*[sort_key(*o) for o in orders])).alias("o")).select("*", "o.*").drop("o")
    order = ["nulls", "by", "student_id"]
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*used, "column", "ranking").orderBy(*order))).filter(F.col("_n") <= MAX_LIMIT)
    first = written(first.drop("_n"), "answer-rows").withColumn("cell_of", _cell_map(used))
    hit = distinct.select("id", "column", "ranking", "row_limit", "filters").join(first, ["column", "ranking"]).filter(_allowed(F.col("cell_of")))
    ranked = hit.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= F.col("row_limit")).select("id", "rank", "value", "student_name", "degree", "year_of_study", "accommodation")


def answer(intents: DataFrame, view: DataFrame, keys=("conv_id", "turn")) -> DataFrame:
    """Every question's answer: (keys, kind, rank, groups, value_name, value, aggregate_utilisation_pct, student columns).

    Each answer equals ``metric_query`` for its intent: groups by value in the ranking's direction with the group's values as
    tiebreak (a lone year by its ordinal), at most ``row_limit`` of them; ``groups`` joins the values by ``|``.
    Refused questions have no answer. Counts and scalars over no rows give 0 and null. No questions: no rows.
    """
    plan = written(plan_intents(intents, keys), "answer-plan")
    column = F.element_at(F.create_map(*[x for n, m in MEASURES.items() for x in (F.lit(n), F.lit("total_expenses" if n == "student_count" else m.column))]), F.col("measure"))
    distinct = plan.drop(*keys).dropDuplicates(["id"]).withColumn("column", column)
    listed = F.col("kind").isin("listing", "extreme")
    shapes = distinct.select("cell", listed.alias("listed"), F.when(~listed & (F.col("agg") == "median"), F.col("measure")).alias("median"),
                             F.when(listed, F.struct("column", "ranking")).alias("order")).distinct().collect()
    unknown = {d for s in shapes for d in s["cell"]} - set(DIMENSIONS)
    if unknown:
        raise KeyError(f"no such dimensions: {sorted(unknown)}")
    sets = sorted({tuple(s["cell"]) for s in shapes if not s["listed"]})
    parts = []
    nothing = {c: F.lit(None).cast("string") for c in ("student_name", "degree", "year_of_study", "accommodation")}
    if sets:
        asked = distinct.filter(~listed)
        got = _aggregates(asked, view, [list(s) for s in sets])
        medians = sorted({s["median"] for s in shapes if s["median"]})
        if medians:
            of_medians = sorted({tuple(s["cell"]) for s in shapes if s["median"]})
            found = _medians(asked.filter("agg = 'median'"), view, [list(s) for s in of_medians], medians)
            got = got.join(found, ["id", "gvals"], "left")
            got = got.withColumn("value", F.coalesce("value", "median"))
        # counts and scalars answer even where no row is left
        got = asked.select("id", "kind", "measure", "agg", "dims", "ranking", "row_limit").join(got, "id", "left").filter("kind <> 'group' or gvals is not null")
        value = F.when(F.col("agg") == "count", F.coalesce("value", F.lit(0.0))).otherwise(F.col("value"))
        by_year = F.col("dims") == F.array(F.lit("year_of_study"))
        ordinal = F.coalesce(F.when(by_year, year_ordinal(F.col("gvals")[0])), F.lit(99))
        up = F.col("ranking") == "asc"
        key = F.when(by_year, 0.0).otherwise(F.when(up, F.col("value")).otherwise(-F.col("value")))
        nulls = F.when(by_year, 0).otherwise(F.when(up, F.col("value").isNotNull().cast("int")).otherwise(F.col("value").isNull().cast("int")))
        got = got.withColumn("value", value).withColumns({"_o": ordinal, "_z": nulls, "_k": key})
        got = got.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("_o", "_z", "_k", "gvals"))).filter(F.col("rank") <= F.col("row_limit"))
        name = F.when(F.col("agg") == "count", F.lit("students")).otherwise(F.concat_ws("_", "agg", "measure"))
        ratio = F.when((F.col("measure") == _TENTHS) & (F.col("kind") == "group"), F.col("ratio"))
        parts.append(got.select("id", "rank", _text(F.coalesce("gvals", F.array().cast("array<string>"))).alias("groups"), name.alias("value_name"), "value",
                                ratio.alias("aggregate_utilisation_pct"), *[c.alias(n) for n, c in nothing.items()]))
    orders = sorted({tuple(s["order"]) for s in shapes if s["order"]})
    if orders:
        used = sorted({d for s in shapes if s["listed"] for d in s["cell"]})
        rows = _listings(distinct.filter(listed), view, used, orders).join(distinct.select("id", "kind", "column"), "id")
        parts.append(rows.select("id", "rank", F.lit("").alias("groups"), F.col("column").alias("value_name"), "value", F.lit(None).cast("double").alias("aggregate_utilisation_pct"),
                                 "student_name", "degree", "year_of_study", F.when(F.col("kind") == "extreme", F.col("accommodation")).alias("accommodation")))
    if not parts:
        return plan.select(*keys, "kind", F.lit(0).alias("rank"), *[F.lit("").alias(c) for c in ("groups", "value_name")], *[F.lit(0.0).alias(c) for c in ("value", "aggregate_utilisation_pct")],
                           *[c.alias(n) for n, c in nothing.items()]).limit(0)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return plan.select(*keys, "id", "kind").join(out, "id").select(*keys, *ANSWER_COLUMNS)
