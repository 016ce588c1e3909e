"""Centroid clustering by Shallot search, in exact integers.

Every vector remembers its nearest and second-nearest centroid, an upper bound ``u`` on the distance to the nearest and a
lower bound ``l`` on the distance to any other. A round moves the bounds by what the centroids moved. Where they
don't decide, the search starts at the closer of the two remembered centroids and goes through that centroid's neighbours by
distance, up to ``d(nearest) + d(second)`` from it: what lies beyond is farther than the second. The ball shrinks
whenever a closer second is found. Bounds are floats rounded outwards; distances that decide are integers.

Vectors lie in blocks of rows that tasks read, update and write again; every task adds a row with the sums of its
clusters, so a round is one pass and a shuffle of k * dim numbers from each task. Centroids (k * dim numbers) are all that
reaches the driver.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import discard, materialize

BLOCK_ROWS = 4096
LONG = 2 ** 63
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12
_STATE = "ids array<long>, vecs binary, width int, a binary, b binary, u binary, l binary, d binary, sums array<decimal(38,0)>"
_NAMES = ["ids", "vecs", "width", "a", "b", "u", "l", "d", "sums"]
_WIDE = pa.list_(pa.decimal128(38, 0))


def _blocks(vectors: DataFrame, dim: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(ids, vecs, width): the usable vectors as rows of floor(scale * x), in the narrowest of 2, 4 and 8 bytes a component."""
    def run(it):
        for batch in it:
            ok = pc.is_valid(batch.column("vec"))
            ids, vecs = batch.column("id").filter(ok), batch.column("vec").filter(ok)
            offs = vecs.offsets.to_numpy().astype(np.int64)
            x = vecs.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
            bad = np.append(0, np.cumsum(~np.isfinite(x)))
            rows = np.flatnonzero((np.diff(offs) == dim) & (bad[offs[1:]] == bad[offs[:-1]]))
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * np.where(np.isfinite(x), x, 0)), -float(LONG), float(LONG - 1024)).astype(np.int64)
            for i in range(0, len(rows), BLOCK_ROWS):
                at = rows[i:i + BLOCK_ROWS]
                m = x[offs[at][:, None] + np.arange(dim)]
                kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max)
                yield pa.RecordBatch.from_arrays([pa.array([ids.take(pa.array(at)).to_pylist()], pa.list_(pa.int64())), pa.array([m.astype(kind).tobytes()], pa.binary()),
                                                  pa.array([int(kind[2])], pa.int32())], ["ids", "vecs", "width"])

    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return src.mapInArrow(run, "ids array<long>, vecs binary, width int")


def _first_centroids(vectors: DataFrame, k: int, dim: int, scale: int, id_col: str, vec_col: str) -> np.ndarray:
    """The vectors with the k smallest sha256 of ``2:<id>``, quantised; equal hashes go by their components."""
    ok = (F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.sha2(F.concat(F.lit("2:"), F.col(id_col).cast("long").cast("string")), 256).alias("h"), F.col(vec_col).cast("array<double>").alias("v"))
            .filter(F.col("v").isNotNull() & ok).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect())
    x = np.array([r["v"] for r in rows], float).reshape(len(rows), dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -float(LONG), float(LONG - 1024)).astype(np.int64)


def _widest(*arrays: np.ndarray) -> int:
    return max((max(int(x.max()), -int(x.min())) for x in arrays if x.size), default=0)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows paired one to one: 64-bit integers, Python's where those could overflow."""
    if x.shape[1] * (2 * _widest(x, c)) ** 2 < LONG:
        return ((x - c) ** 2).sum(axis=1)
    return ((x.astype(object) - c.astype(object)) ** 2).sum(axis=1)


def _all_squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every centroid."""
    if x.shape[1] * (2 * _widest(x, c)) ** 2 < 2 ** 53:
        f, g = x.astype(float), c.astype(float)
        return ((f * f).sum(axis=1)[:, None] + (g * g).sum(axis=1)[None, :] - 2 * (f @ g.T)).astype(np.int64)
    return np.stack([_squared(x, np.broadcast_to(r, x.shape)) for r in c], axis=1)


def _root(sq: np.ndarray, toward: float) -> np.ndarray:
    return np.sqrt(sq.astype(float)) * toward


class Neighbours:
    """Centroids by distance from each centroid, and half the distance to the closest one (lower bounds)."""

    def __init__(self, c: np.ndarray):
        k = len(c)
        sq = _all_squared(c, c)
        self.order = np.stack([np.array([j for j in sorted(range(k), key=lambda j, r=r: (r[j], j)) if j != i], int) for i, r in enumerate(sq)]) if k else np.empty((0, 0), int)
        self.at = np.stack([_root(sq[i][self.order[i]], _DOWN) for i in range(k)]) if k > 1 else np.empty((k, 0))
        self.half = self.at[:, 0] / 2 if k > 1 else np.full(k, np.inf)


def scan_all(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """a, b, u, l of every row by a full scan; ties go to the smaller number."""
    sq, row = _all_squared(x, c), np.arange(len(x))
    a = sq.argmin(axis=1)
    if len(c) == 1:
        return a, np.full(len(x), -1), _root(sq[row, a], _UP), np.full(len(x), np.inf)
    rest = sq.copy()
    rest[row, a] = rest.max() + 1 if rest.dtype == object else np.iinfo(np.int64).max
    b = rest.argmin(axis=1)
    return a, b, _root(sq[row, a], _UP), _root(rest[row, b], _DOWN)


def search(x: np.ndarray, c: np.ndarray, near: Neighbours, moved: np.ndarray, a: np.ndarray, b: np.ndarray, u: np.ndarray, l: np.ndarray) -> tuple[np.ndarray, ...]:
    """a, b, u, l of every row after the centroids moved by at most ``moved``."""
    a, b, k = a.copy(), b.copy(), len(c)
    if k == 1:
        return a, b, _root(_squared(x, c[a]), _UP), l
    if x.shape[1] * (2 * _widest(x, c)) ** 2 >= LONG:
        x, c = x.astype(object), c.astype(object)
    top = np.argsort(-moved, kind="stable")
    u = (u + moved[a]) * _UP
    l = np.maximum(l - np.where(a == top[0], moved[top[1]], moved[top[0]]), 0) * _DOWN
    left = np.flatnonzero(u >= np.maximum(l, near.half[a]))
    u[left] = _root(_squared(x[left], c[a[left]]), _UP)
    left = left[u[left] >= np.maximum(l[left], near.half[a[left]])]
    if not len(left):
        return a, b, u, l
    y, first, second = x[left], a[left], b[left]
    d1, d2 = _squared(y, c[first]), _squared(y, c[second])
    swap = (d2 < d1) | ((d2 == d1) & (second < first))
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    origin, known, start = first.copy(), second.copy(), _root(d1, _UP)
    live = np.arange(len(left))
    for t in range(k - 1):
        # a centroid beyond the ball is farther than the second, and so are all behind it
        live = live[near.at[origin[live], t] <= (start[live] + _root(d2[live], _UP)) * _UP]
        if not len(live):
            break
        j = near.order[origin[live], t]
        new = j != known[live]
        at, j = live[new], j[new]
        d = _squared(y[at], c[j])
        wins = (d < d1[at]) | ((d == d1[at]) & (j < first[at]))
        w = at[wins]
        second[w], d2[w] = first[w], d1[w]
        first[w], d1[w] = j[wins], d[wins]
        closer = ~wins & (d < d2[at])
        s = at[closer]
        second[s], d2[s] = j[closer], d[closer]
    a[left], b[left] = first, second
    u[left], l[left] = _root(d1, _UP), _root(d2, _DOWN)
    return a, b, u, l


def _sums(x: np.ndarray, a: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each cluster and, as a last column, their number, exact."""
    with_count = np.concatenate([x.astype(np.int64), np.ones((len(x), 1), np.int64)], axis=1)
    if len(x) * _widest(with_count) >= LONG:
        with_count = with_count.astype(object)
    order = np.argsort(a, kind="stable")
    seen, start = np.unique(a[order], return_index=True)
    out = np.zeros((k, x.shape[1] + 1), object)
    out[seen] = np.add.reduceat(with_count[order], start, axis=0).astype(object)
    return out


def _round(state: DataFrame, c: np.ndarray, moved: np.ndarray | None, last: bool) -> DataFrame:
    """One assignment: the updated blocks, and a row from each task with its clusters' sums (at last: of distances)."""
    k, dim = c.shape

    def run(it):
        near, total = Neighbours(c), np.zeros((k, 1 if last else dim + 1), object)
        for batch in it:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                x = np.frombuffer(col["vecs"][r].as_py(), f"<i{col['width'][r].as_py()}").reshape(-1, dim).astype(np.int64)
                if moved is None:
                    a, b, u, l = scan_all(x, c)
                else:
                    a, b, u, l = search(x, c, near, moved, *(np.frombuffer(col[n][r].as_py(), t).astype(s) for n, t, s in (("a", "<i4", int), ("b", "<i4", int), ("u", "<f8", float), ("l", "<f8", float))))
                d = b""
                if last:
                    sq = _squared(x, c[a])
                    np.add.at(total[:, 0], a, sq.astype(object))
                    d = np.array([min(v, LONG - 1) for v in sq.tolist()], "<i8").tobytes()
                else:
                    total += _sums(x, a, k)
                yield pa.RecordBatch.from_arrays([col["ids"].slice(r, 1), col["vecs"].slice(r, 1), col["width"].slice(r, 1), *(pa.array([v], pa.binary()) for v in (
                    a.astype("<i4").tobytes(), b.astype("<i4").tobytes(), u.astype("<f8").tobytes(), l.astype("<f8").tobytes(), d)), pa.nulls(1, _WIDE)], _NAMES)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), *(pa.nulls(1, pa.binary()) for _ in range(5)),
                                          pa.array([[Decimal(int(v)) for v in total.ravel()]], _WIDE)], _NAMES)

    return state.mapInArrow(run, _STATE)


def _collected(state: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    got = state.filter("sums is not null").select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").cast("string").alias("x")).collect()
    out = np.zeros(shape[0] * shape[1], object)
    for r in got:
        out[r["i"]] = int(r["x"])
    return out.reshape(shape)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of ``dim`` finite components.

    Centroids start as the k vectors with the smallest sha256 of ``2:<id>``; each round assigns all vectors to the
    nearest centroid (ties: smaller number) and moves every non-empty centroid to the floor of its vectors' means; then
    they are assigned once more. Null vectors, other lengths and vectors with null or non-finite components are left out. Rows
    without an id are kept (their hash sorts last); rows that repeat an id, or equal vectors, are vectors of their own; equal
    hashes start in the order of their components. Fewer than k vectors: as many centroids. No vectors: no rows. Components and
    distances beyond the long range stop at its ends. Other columns are not read.
    """
    spark = vectors.sparkSession
    c = _first_centroids(vectors, k, dim, scale, id_col, vec_col)
    if not len(c):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    k, moved = len(c), None
    state = materialize(_blocks(vectors, dim, scale, id_col, vec_col), "vectors")
    for _ in range(rounds):
        after = materialize(_round(state.filter("vecs is not null"), c, moved, False), "clusters")
        discard(state)
        state, total = after, _collected(after, (k, dim + 1))
        new = np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(total.tolist(), c.tolist())], np.int64).reshape(k, dim)
        moved, c = _root(_squared(c, new), _UP), new
    after = materialize(_round(state.filter("vecs is not null"), c, moved, True), "clusters")
    discard(state)
    by = [int(v) for v in _collected(after, (k, 1))[:, 0]]
    inertia, own = min(sum(by), LONG - 1), np.array([min(v, LONG - 1) for v in by], np.int64)
    digest = pa.array([hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in c.tolist()])

    def rows(it):
        for batch in it:
            ids, a, d = (batch.column(i) for i in range(3))
            for r in range(batch.num_rows):
                at = np.frombuffer(a[r].as_py(), "<i4")
                yield pa.RecordBatch.from_arrays([ids[r].values, pa.array(at), pa.array(np.frombuffer(d[r].as_py(), "<i8")), pa.array(own[at]), pa.array(np.full(len(at), inertia, np.int64)),
                                                  digest.take(pa.array(at))], ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return after.filter("vecs is not null").select("ids", "a", "d").mapInArrow(rows, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def duckdb_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """DuckDB SQL for ``cluster`` over ``embeddings``: every round scans all centroids."""
    sql = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, x) - 1 AS INTEGER) AS j, x FROM v QUALIFY j < {k})"""]
    for i in range(rounds + 1):
        sql.append(f"""d{i} AS (SELECT v.r, c.j, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i} c),
a{i} AS MATERIALIZED (SELECT r, j, CAST(d AS BIGINT) AS d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < rounds:
            sql.append(f"""e{i} AS (SELECT a.j, p.i, sum(v.x[p.i]) AS s, count(*) AS n FROM a{i} a JOIN v USING (r), range(1, {dim + 1}) p(i) GROUP BY a.j, p.i),
m{i} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM e{i} GROUP BY j),
c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (j))""")
    return ",\n".join(sql) + f"""
SELECT v.vec_id, a.j AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c USING (j)"""
