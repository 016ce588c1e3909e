import math

import numpy as np

from censusflow.llm import registry
from censusflow.llm.topk import top_k

from conftest import assert_matches_oracle


def brute(rows, k, mod):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for qi, q in ok:
        if qi % mod == 0:
            found = {(-sum(a * b for a, b in zip(q, c)), ci) for ci, c in ok if ci != qi and len(c) == len(q)}
            out.setdefault(qi, set()).update(found)
    return {(qi, r + 1, ci, -s) for qi, f in out.items() for r, (s, ci) in enumerate(sorted(f)[:k])}


def check(spark, rows, k=5, mod=4):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    got = {tuple(r) for r in top_k(df, k=k, query_modulus=mod).collect()}
    clean = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute(clean, k, mod)


def test_ties_nulls_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(100, 140)]           # one hot vector: all tied
    rows += [(8, rows[8][1]), (101, [0.5] * 4), (101, [0.25] * 4)]          # repeated rows
    rows += [(None, [1.0] * 4), (200, None), (204, [1.0, None, 1.0, 1.0]), (208, [float("nan")] * 4), (212, [float("inf")] * 4)]
    rows += [(216, [1.0, 2.0]), (217, [3.0, -1.0]), (220, [])]              # other dimensions
    check(spark, rows)


def test_few_and_none(spark):
    check(spark, [(0, [1.0, 2.0]), (1, [0.1, 0.2])])
    check(spark, [(4, [1.0])])
    check(spark, [])


def test_large_values_stay_exact(spark):
    check(spark, [(i, [2.0 ** 20 + i, -(2.0 ** 22) * i]) for i in range(9)])
    df = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.score for r in top_k(df, query_modulus=5).collect()}
    assert got == {1: 2 ** 63 - 1, 2: -2 ** 63}


def test_query_matches_sql(spark, sf_dir, duck):
    assert_matches_oracle(registry.op3_topk(spark, sf_dir), duck, registry.SQL["op3_topk"])
