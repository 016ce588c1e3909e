"""Many questions answered in one job: each answer equals its own metric query."""

import random

import pytest

from censusflow.plans import metrics as M
from censusflow.plans import pipeline
from censusflow.plans.answers import answer

INTENT = ("conv_id long, turn long, measure string, aggregation string, dimensions array<string>, filters array<struct<dim:string,value:string,negated:boolean>>, "
          "compare_dim string, compare_values array<string>, ranking string, row_limit long, detail boolean, extreme boolean, refused boolean")


@pytest.fixture(scope="module")
def view(spark, sf_dir):
    return pipeline.survey_view(spark, sf_dir).cache()


def request(rng):
    closed = [d for d in M.DIMENSIONS if M.DIMENSIONS[d]]
    dims = rng.sample(sorted(M.DIMENSIONS), rng.choice([0, 0, 1, 1, 2]))
    dims = rng.choice([dims, dims, ["year_of_study"]])
    free = [d for d in closed if d not in dims]
    filters = [(d, rng.choice(M.DIMENSIONS[d]), rng.random() < 0.4) for d in rng.sample(free, rng.choice([0, 0, 1, 2]))]
    shape = rng.choice(["agg"] * 6 + ["detail", "extreme", "compare"])
    measure = rng.choice([*M.MEASURES, None] if shape in ("agg", "detail") else [m for m in M.MEASURES if m != "student_count"])
    compare = (dims[0], sorted(rng.sample(M.DIMENSIONS[dims[0]], 2))) if shape == "compare" and dims and M.DIMENSIONS[dims[0]] else (None, None)
    return {"measure": measure, "aggregation": rng.choice([*M.AGGREGATIONS, "median"]), "dimensions": dims if shape != "extreme" else [], "filters": filters, "compare_dim": compare[0],
            "compare_values": compare[1], "ranking": rng.choice([None, "asc", "desc"]), "row_limit": rng.choice([1, 3, 50]), "detail": shape == "detail", "extreme": shape == "extreme", "refused": False}


def alone(view, r):
    compare = (r["compare_dim"], r["compare_values"]) if r["compare_dim"] else None
    plain = r["measure"] is None and not r["detail"] and not r["extreme"]
    df = M.metric_query(view, r["measure"] or "student_count", "count" if plain else r["aggregation"], [] if plain else r["dimensions"], r["filters"],
                        compare, r["ranking"] or "desc", r["row_limit"], r["detail"], r["extreme"])
    rows = df.collect()
    dims = [] if plain or r["detail"] or r["extreme"] else r["dimensions"]
    listed = r["detail"] or r["extreme"]
    column = "total_expenses" if r["measure"] in (None, "student_count") else M.MEASURES[r["measure"]].column
    name = column if listed else next(c for c in df.columns if c not in dims and c != "aggregate_utilisation_pct")
    out = []
    for i, x in enumerate(rows):
        value = None if x[name] is None else round(float(x[name]), 6)
        who = tuple(x[c] if listed and c in df.columns and (c != "accommodation" or r["extreme"]) else None for c in ("student_name", "degree", "year_of_study", "accommodation"))
        ratio = x["aggregate_utilisation_pct"] if "aggregate_utilisation_pct" in df.columns else None
        out.append((i + 1, "|".join("" if x[d] is None else x[d] for d in dims), name, value, ratio, *who))
    return out


def test_equal_to_one_query_each(spark, view):
    rng = random.Random(7)
    requests = [request(rng) for _ in range(30)]
    requests += [dict(requests[0]), {**requests[0], "refused": True},
                 {**requests[0], "measure": "allowance", "aggregation": "avg", "dimensions": [], "compare_dim": None, "detail": False, "extreme": False,
                  "filters": [("gender", "Male", False), ("gender", "Female", False)]},
                 {**requests[0], "measure": None, "dimensions": [], "compare_dim": None, "detail": False, "extreme": False, "filters": [("gender", "Male", False), ("gender", "Male", True)]}]
    df = spark.createDataFrame([{"conv_id": 1, "turn": i, **r} for i, r in enumerate(requests)], INTENT)
    got = {}
    for x in answer(df, view).collect():
        got.setdefault(x["turn"], []).append((x["rank"], x["groups"], x["value_name"], None if x["value"] is None else round(x["value"], 6), x["aggregate_utilisation_pct"], x["student_name"], x["degree"], x["year_of_study"], x["accommodation"]))
    for i, r in enumerate(requests):
        if r["refused"]:
            assert i not in got
            continue
        assert sorted(got.get(i, [])) == sorted(alone(view, r)), r


def test_no_questions(spark, view):
    assert answer(spark.createDataFrame([], INTENT), view).collect() == []


def test_unknown_dimension_is_refused(spark, view):
    row = {**request(random.Random(1)), "conv_id": 1, "turn": 0, "dimensions": ["colour"], "measure": "allowance", "detail": False, "extreme": False, "compare_dim": None}
    with pytest.raises(KeyError):
        answer(spark.createDataFrame([row], INTENT), view)
