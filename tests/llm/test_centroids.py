import hashlib
import math
import random

import numpy as np
import pytest

from censusflow.llm import registry
from censusflow.llm.centroids import Neighbours, _all_squared, _root, cluster, scan_all, search

from conftest import assert_matches_oracle

DIM = 4


def brute(rows, k, rounds, scale=256):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == DIM and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~"
    cents = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        cents = [[sum(x) // len(m) for x in zip(*m)] if (m := [v for (_, v), j in zip(kept, own) if j == c]) else old for c, old in enumerate(cents)]
    last = [(i, *near(v)) for i, v in kept]
    by = {}
    for _, d, j in last:
        by[j] = by.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    long = lambda v: min(v, 2 ** 63 - 1)
    return sorted(((i, j, long(d), long(by[j]), long(sum(by.values())), sha[j]) for i, d, j in last), key=repr)


def check(spark, rows, k=6, rounds=4, kind="float"):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string").repartition(3)
    got = sorted((tuple(r) for r in cluster(df, k=k, rounds=rounds, dim=DIM).collect()), key=repr)
    as_read = [(i, v and [x if x is None or kind == "double" else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute(as_read, k, rounds)


def test_random_ties_repeats_nulls(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(DIM)]) for i in range(150)]
    rows += [(i, [0.5] * DIM) for i in range(200, 260)] + [(i, [rng.randrange(-1, 2) / 2 for _ in range(DIM)]) for i in range(300, 380)]
    rows += [(3, rows[3][1]), (3, [9.0] * DIM), (None, [0.25] * DIM), (400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * DIM), (403, [float("inf")] * DIM), (404, [1.0]), (405, [])]
    check(spark, rows)
    check(spark, rows, k=25, rounds=5)
    check(spark, rows, k=1)


def test_few_none_wide(spark):
    check(spark, [(1, [0.0] * DIM), (2, [0.0] * DIM), (5, [1.0] * DIM)], k=5)
    check(spark, [(1, None)])
    check(spark, [])
    rng = random.Random(4)
    check(spark, [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(0, 20) for _ in range(DIM)]) for i in range(60)], kind="double")
    wide = [(i, [2.0 ** 40 + i, -2.0 ** 30 * i, 0.0, 1.0 * i]) for i in range(30)]
    check(spark, [r for r in wide if r[0] < 3] + [(50 + i, [2.0 ** 21 * i, 0.0, 1.0, 2.0]) for i in range(20)], k=4, kind="double")


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_lose_the_nearest(seed):
    """The pruned search gives a full scan's clusters whatever the centroids do, on lattices full of ties."""
    rng = np.random.default_rng(seed)
    k, span = int(rng.integers(1, 12)), int(rng.integers(2, 40))
    x, c = rng.integers(-span, span, (300, 3)), rng.integers(-span, span, (k, 3))
    a, b, u, l = scan_all(x, c)
    for _ in range(6):
        new = c + rng.integers(-3, 4, c.shape) * (rng.random((k, 1)) < 0.7)
        moved, c = _root(((c - new) ** 2).sum(axis=1), 1 + 1e-12), new
        a, b, u, l = search(x, c, Neighbours(c), moved, a, b, u, l)
        sq = _all_squared(x, c)
        assert (a == sq.argmin(axis=1)).all()
        others = np.where(np.arange(k)[None] == a[:, None], np.iinfo(np.int64).max, sq)
        assert (u >= np.sqrt(sq.min(axis=1)) * (1 - 1e-15)).all() and (k == 1 or (l <= np.sqrt(others.min(axis=1))).all())


def test_query_matches_sql(spark, sf_dir, duck):
    assert_matches_oracle(registry.op13_centroids(spark, sf_dir), duck, registry.SQL["op13_centroids"])
