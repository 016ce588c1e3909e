"""Quality checks as mergeable states: a load leaves what the checks need, and an append is judged against all rows.

The state of a load is four tables, each made by one aggregation with map-side combining:

* ``fused``: the row of counts and extremes of the fused scan, callers' own checks included;
* ``keys``: (name, timestamp, 128-bit row key, rows), which the three duplicate checks need;
* ``values``: (kind, column, value, amount, rows) of amounts, values off their list and the free-text column;
* ``examples``: the few smallest offending values of each check.

States of several loads are the union of their rows; ``state_findings`` aggregates them again (sums, extremes, sketches) and
gives the report that ``run_quality_checks`` gives over all loads' rows at once. With ``sketches`` the amounts and
the free text are kept as sketches in ``fused`` (see ``sketches.py``): bounded in size, and approximate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec
from ..functions.columns import col_of, count_if
from . import quality as Q
from .sketches import MERGE, distinct_sketch, quantile_sketch, sketch_n, sketch_quantile, sketch_rank

PARTS = ("columns", "fused", "keys", "values", "examples")
FREE_TEXT = "Specialization"
_NAME, _TIME = "Student Name", "Timestamp"


@dataclass(frozen=True)
class GateState:
    columns: DataFrame   # no rows; the survey's columns
    fused: DataFrame
    keys: DataFrame
    values: DataFrame
    examples: DataFrame

    @property
    def sketched(self) -> bool:
        return any(c.startswith("quantiles::") for c in self.fused.columns)


def _planned(columns: DataFrame, as_of: str | None, domains: dict, own: Iterable[Q.OwnCheck]) -> tuple[Q._Plan, Q._Layout]:
    p = Q._Plan(columns)
    at = Q._layout(p, set(Q.CHECK_GROUPS), as_of, domains, own)
    p.aggs.setdefault("n", F.count(F.lit(1)))
    return p, at


def _add_sketches(p: Q._Plan) -> None:
    for c in Q._money_present(p):
        p.agg(f"quantiles::{c}", quantile_sketch(p.num(c)))
        p.merges[f"quantiles::{c}"] = "quantiles"
        p.agg(f"distinct::{c}", distinct_sketch(p.num(c).cast("string")))
        p.merges[f"distinct::{c}"] = "distinct"
    if p.has(FREE_TEXT):
        p.agg(f"distinct::{FREE_TEXT}", distinct_sketch(p.col(FREE_TEXT).cast("string")))
        p.merges[f"distinct::{FREE_TEXT}"] = "distinct"


def gate_state(display: DataFrame, as_of: str | None = None, domains: dict | None = None, key: str | None = "response_id",
               own: Iterable[Q.OwnCheck] = (), sketches: bool = False) -> GateState:
    """The state of one load (lazy). ``as_of`` is the load's own moment: later loads don't look at its timestamps again.

    A load without rows has a state of its own: counts of 0, no keys, no values.
    """
    survey = Q.survey_columns(display, key)
    domains = spec.DOMAINS if domains is None else domains
    p, _ = _planned(survey, as_of, domains, own)
    if sketches:
        _add_sketches(p)
    off = Q._off_domain(p, domains)
    p.examples += [(f"domain::{c}", bad, v) for c, bad, v in off]

    def cell(when: Column, kind: str, column: str, value: Column, amount: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(column).alias("column"), value.cast("string").alias("value"), amount.cast("double").alias("amount")))

    none, always = F.lit(None), F.lit(True)
    cells = [cell(bad, "domain", c, v, none) for c, bad, v in off]
    if not sketches:
        cells += [cell(p.num(c).isNotNull(), "money", c, none, p.num(c)) for c in Q._money_present(p)]
        cells += [cell(always, "text", FREE_TEXT, p.col(FREE_TEXT), none)] if p.has(FREE_TEXT) else []
    cells = cells or [cell(F.lit(False), "none", "", none, none)]
    named = [(p.col(c) if p.has(c) else none).cast("string").alias(a) for c, a in ((_NAME, "nm"), (_TIME, "ts"))]
    return GateState(
        survey.limit(0), survey.agg(*[e.alias(k) for k, e in p.aggs.items()]),
        survey.select(*named, *Q.row_keys(survey)).groupBy("nm", "ts", "h1", "h2").agg(F.count(F.lit(1)).alias("k")),
        survey.select(F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("x")).select("x.*")
        .groupBy("kind", "column", "value", "amount").agg(F.count(F.lit(1)).alias("k")),
        Q._examples(p))


def merged(state: GateState, as_of: str | None = None, domains: dict | None = None, own: Iterable[Q.OwnCheck] = ()) -> GateState:
    """The state of all loads that ``state`` holds, as if they had been one."""
    p, _ = _planned(state.columns, as_of, spec.DOMAINS if domains is None else domains, own)
    if state.sketched:
        _add_sketches(p)
    absent = [k for k in p.aggs if k not in state.fused.columns]
    if absent:
        raise ValueError(f"the loads' states lack {absent}: they were made by other checks")
    return GateState(
        state.columns, state.fused.agg(*[MERGE[p.merge(k)](col_of(k)).alias(k) for k in p.aggs]),
        state.keys.groupBy("nm", "ts", "h1", "h2").agg(F.sum("k").alias("k")),
        state.values.groupBy("kind", "column", "value", "amount").agg(F.sum("k").alias("k")),
        Q.smallest_examples(state.examples.select("name", F.explode("examples").alias("value"))))


def union_states(states: Sequence[GateState]) -> GateState:
    """Several loads as one state. All must have the same columns."""
    first = states[0]
    for s in states[1:]:
        if s.columns.dtypes != first.columns.dtypes or set(s.fused.columns) != set(first.fused.columns):
            raise ValueError("states of loads with other columns or checks do not merge")
    return GateState(first.columns, *[reduce(DataFrame.unionByName, [getattr(s, part) for s in states]) for part in PARTS[1:]])


def write_state(state: GateState, path: str) -> str:
    """Write a state's tables below ``path`` (replacing what is there) and return ``path``."""
    for part in PARTS:
        getattr(state, part).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{part}")
    return path


def read_states(spark: SparkSession, paths: Sequence[str]) -> GateState:
    """The written states of one or more loads as one state; one read a table, however many loads there are."""
    at = {part: [f"{p.rstrip('/')}/{part}" for p in paths] for part in PARTS}
    kinds = {part: [spark.read.parquet(p).schema for p in (at[part][0], at[part][-1])] for part in ("columns", "fused")}
    if any(a != b for a, b in kinds.values()):
        raise ValueError("states of loads with other columns or checks do not merge")
    return GateState(*[spark.read.schema(spark.read.parquet(at[part][0]).schema).parquet(*at[part]) for part in PARTS])


def _sketched_outliers(p: Q._Plan, fused: DataFrame) -> DataFrame:
    """One struct a money column, as the exact check has it; how many lie beyond a fence comes from ranks."""
    steps, out = {}, []
    for i, c in enumerate(Q._money_present(p)):
        s = col_of(f"quantiles::{c}")
        steps |= {f"n{i}": sketch_n(s), f"q{i}": sketch_quantile(s, 0.25), f"r{i}": sketch_quantile(s, 0.75)}
    fused = fused.withColumns(steps)
    fences = {}
    for i, _ in enumerate(Q._money_present(p)):
        iqr = F.col(f"r{i}") - F.col(f"q{i}")
        fences |= {f"iqr{i}": iqr, f"lo{i}": F.col(f"q{i}") - spec.IQR_MULTIPLIER * iqr, f"hi{i}": F.col(f"r{i}") + spec.IQR_MULTIPLIER * iqr}
    fused = fused.withColumns(fences)
    for i, c in enumerate(Q._money_present(p)):
        s, n, lo, hi = col_of(f"quantiles::{c}"), F.col(f"n{i}"), F.col(f"lo{i}"), F.col(f"hi{i}")
        # the extremes are exact: where one is beyond its fence, at least one row is
        below = F.when(sketch_quantile(s, 0.0) < lo, F.greatest(F.lit(1.0), F.round(sketch_rank(s, lo) * n))).otherwise(0)
        above = F.when(sketch_quantile(s, 1.0) > hi, F.greatest(F.lit(1.0), F.round((1 - sketch_rank(s, hi)) * n))).otherwise(0)
        out.append(F.struct(n.alias("n"), F.col(f"iqr{i}").alias("iqr"), lo.alias("lo"), hi.alias("hi"),
                            F.coalesce(F.hll_sketch_estimate(col_of(f"distinct::{c}")), F.lit(0)).cast("long").alias("d"),
                            (below + above).cast("long").alias("cnt")).alias(f"o::{c}"))
    return fused.select(*out)


def state_findings(state: GateState, as_of: str | None = None, domains: dict | None = None, own: Iterable[Q.OwnCheck] = (),
                   examples: bool = True) -> DataFrame:
    """The report of ``run_quality_checks`` over all rows of the loads in ``state``, from their states alone."""
    domains = spec.DOMAINS if domains is None else domains
    own = tuple(own)
    whole = merged(state, as_of, domains, own)
    p, at = _planned(state.columns, as_of, domains, own)
    fused, keys, values = whole.fused, whole.keys, whole.values
    frames = [Q._from_agg(fused, at.fused)]

    exact = keys.groupBy("h1", "h2").agg(F.sum("k").alias("k"))
    dup = F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("dup")
    parts = Q._exact_rows(p, at.duplicates, exact.agg(dup, F.sum("k").alias("rows")))
    if p.has(_NAME) and p.has(_TIME):
        parts += Q._name_timestamp_rows(at.duplicates + 1, keys.groupBy("nm", "ts").agg(F.sum("k").alias("k")))
    else:
        parts += Q._name_timestamp_duplicates(p, at.duplicates + 1)
    if p.has(_NAME):
        parts += Q._repeated_rows(at.duplicates + 2, keys.groupBy("nm", "h1", "h2").agg(F.sum("k").alias("c")))
    else:
        parts += Q._repeated_names(p, at.duplicates + 2)
    money = Q._money_present(p)
    if money and state.sketched:
        parts += [(at.outliers, Q._outlier_rows(p, at.outliers, _sketched_outliers(p, fused)))]
    else:
        place = F.create_map(*[F.lit(x) for i, c in enumerate(money) for x in (c, i)]) if money else F.create_map()
        counts = values.filter("kind = 'money'").select(place[F.col("column")].alias("i"), F.col("amount").alias("v"), "k") if money else None
        parts += Q._outliers(p, at.outliers, counts)
    parts += Q._domains(p, at.domains, domains, values.filter("kind = 'domain'").select("column", "value"))
    if not p.has(FREE_TEXT):
        parts += Q._cardinality(p, at.cardinality)
    elif state.sketched:
        parts += Q._cardinality_rows(at.cardinality, fused.select(F.hll_sketch_estimate(col_of(f"distinct::{FREE_TEXT}")).alias("d"), "n"))
    else:
        texts = values.filter("kind = 'text'")
        parts += Q._cardinality_rows(at.cardinality, texts.agg(count_if(F.col("value").isNotNull()).alias("d"), F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("n")))
    return Q._report([*frames, *[f for _, f in parts]], whole.examples if examples else None)
