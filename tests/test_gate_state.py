"""States of loads, callers' checks and sketches against the checks over all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from censusflow.operators import gate_state as G
from censusflow.operators import quality as Q
from censusflow.operators import sketches as S
from censusflow.registry import AS_OF, defect_frame, food_beyond_allowance
from censusflow.sources.artifacts import artifact_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def loads(df, n):
    part = F.pmod(F.xxhash64("response_id"), F.lit(n))
    return [df.filter(part == i) for i in range(n)]


def test_gate_over_loads_equals_gate_over_their_union(spark, sf_dir):
    df = defect_frame(spark, sf_dir)
    own = [food_beyond_allowance()]
    want = rows(Q.run_quality_checks(df, as_of=AS_OF, own=own))
    # rows that stand twice fall into different loads too: the second load repeats a few of the first
    first, second = loads(df, 2)
    again = second.unionByName(first.limit(7))
    paths = [G.write_state(G.gate_state(x, AS_OF, own=own), artifact_path(spark, "gate-state")) for x in (first, again, df.limit(0))]
    got = rows(G.state_findings(G.read_states(spark, paths), AS_OF, own=own))
    assert got == rows(Q.run_quality_checks(first.unionByName(again), as_of=AS_OF, own=own)) and got != want
    three = G.union_states([G.gate_state(x, AS_OF, own=own) for x in loads(df, 3)])
    assert rows(G.state_findings(three, AS_OF, own=own)) == want
    # merged states merge again
    packed = G.write_state(G.merged(three, AS_OF, own=own), artifact_path(spark, "gate-state"))
    assert rows(G.state_findings(G.read_states(spark, [packed]), AS_OF, own=own)) == want


def test_missing_columns_and_other_states(spark, sf_dir):
    df = defect_frame(spark, sf_dir).drop("Specialization", "Timestamp", "Degree")
    assert rows(G.state_findings(G.gate_state(df, AS_OF), AS_OF)) == rows(Q.run_quality_checks(df, as_of=AS_OF))
    with pytest.raises(ValueError):
        G.union_states([G.gate_state(df, AS_OF), G.gate_state(defect_frame(spark, sf_dir), AS_OF)])
    with pytest.raises(ValueError):
        G.merged(G.gate_state(df, AS_OF), AS_OF, own=[food_beyond_allowance()])


def test_row_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    keys = [tuple(r) for r in df.select(*Q.row_keys(df)).collect()]
    assert keys[0] == keys[2] != keys[1]


def test_own_checks_join_the_report(spark, sf_dir):
    df = defect_frame(spark, sf_dir)
    broken = Q.OwnCheck("no_such_column", lambda f: {"n": (F.count(f["nothing"]), "sum")}, lambda s: [])
    raises = Q.OwnCheck("raises", lambda f: 1 / 0, lambda s: [])
    odd = Q.OwnCheck("odd_merge", lambda f: {"n": (F.count(F.lit(1)), "mean")}, lambda s: [])
    plain = Q.run_quality_checks(df, as_of=AS_OF)
    got = Q.run_quality_checks(df, as_of=AS_OF, own=[broken, food_beyond_allowance(), raises, odd])
    extra = {r["name"]: r for r in got.join(plain.select("name"), "name", "left_anti").collect()}
    assert set(extra) == {"no_such_column", "food_beyond_allowance", "raises", "odd_merge"}
    for name in ("no_such_column", "raises", "odd_merge"):
        assert extra[name]["severity"] == "CRITICAL" and extra[name]["category"] == "internal" and not extra[name]["passed"]
    food, allowance = F.col("Food").try_cast("double"), F.col("Allowance").try_cast("double")
    assert extra["food_beyond_allowance"]["offending"] == df.filter(food > allowance).count()
    assert rows(got.join(plain.select("name"), "name", "left_semi").select(plain.columns)) == rows(plain)
    # no further scan: the plan of the fused groups alone has one aggregation either way
    scans = lambda x: x._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    fused = ["row_count", "no_nulls"]
    assert scans(Q.run_quality_checks(df, checks=fused, examples=False, own=[food_beyond_allowance()])) == scans(Q.run_quality_checks(df, checks=fused, examples=False))


def test_sketched_state_is_near_the_exact_one(spark, sf_dir):
    df = defect_frame(spark, sf_dir)
    exact = {r["name"]: r for r in Q.run_quality_checks(df, as_of=AS_OF).collect()}
    paths = [G.write_state(G.gate_state(x, AS_OF, sketches=True), artifact_path(spark, "gate-sketch")) for x in (*loads(df, 3), df.limit(0))]
    state = G.read_states(spark, paths)
    assert state.values.filter("kind <> 'domain'").count() == 0
    got = {r["name"]: r for r in G.state_findings(state, AS_OF).collect()}
    assert set(got) == set(exact)
    n = df.count()
    for name, r in got.items():
        if name.startswith("outliers::"):
            assert r["severity"] == exact[name]["severity"] and abs(r["offending"] - exact[name]["offending"]) <= 0.02 * n
        elif name != "specialization_cardinality":
            assert tuple(r) == tuple(exact[name])


def test_rank_and_distinct_errors_on_ten_million_values(spark):
    n = 10_000_000
    # i * odd mod 2^33: distinct, in no order; half of the parts hold shifted values
    df = spark.range(0, n, 1, 8).select(((F.col("id") * 2654435761) % 8589934592).cast("double").alias("v"), (F.col("id") % 4).alias("part"))
    whole = S.merge_measures(S.sketch_measures(df, ["v"], ["part"]))
    probs = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    r = S.measures_of(whole, probs=probs).first()
    ranks = df.agg(*[F.avg((F.col("v") <= q).cast("int")).alias(f"r{i}") for i, q in enumerate(r["quantiles"])], F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    assert all(abs(ranks[f"r{i}"] - p) <= 0.01 for i, p in enumerate(probs))
    assert (r["n"], r["min_value"], r["max_value"]) == (n, ranks["lo"], ranks["hi"])
    assert abs(r["distinct_values"] - n) <= 0.03 * n
    assert len(whole.first()["quantiles::v"]) < 100_000


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None, "a")], "v double, g string")
    for x in (df, df.limit(0)):
        r = S.measures_of(S.merge_measures(S.sketch_measures(x, ["v"]))).first()
        assert (r["n"], r["min_value"], r["distinct_values"], r["quantiles"]) == (0, None, 0, [None, None, None])


def test_order_of_loads_does_not_matter(spark, sf_dir):
    parts = loads(defect_frame(spark, sf_dir), 3)
    random.Random(3).shuffle(parts)
    states = [G.gate_state(x, AS_OF) for x in parts]
    assert rows(G.state_findings(G.union_states(states), AS_OF)) == rows(G.state_findings(G.union_states(states[::-1]), AS_OF))
