"""Exact top-k search by inner product: tiled matrix products.

Vectors are packed into blocks of rows inside the scan (no shuffle). Blocks of candidates go to shards,
blocks of queries to slices; each (shard, slice) cell is one task's work: a matrix product per pair of
blocks and a partial selection of the k best per query and tile. The per-query lists are merged as a tree,
``FAN_IN`` shards at a time.

A cell holds about ``CELL_ROWS`` candidates and as many queries, so candidates are copied once per slice and
queries once per shard. The number of cells follows from counts; a hot vector is only a tie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import materialize

BLOCK_ROWS, CELL_ROWS, FAN_IN = 4096, 32768, 16
SCALE = 64
LONG = 2 ** 63


def _packed(vectors: DataFrame, id_col: str, vec_col: str, modulus: int) -> DataFrame:
    """(dim, is_query, block, ids, rows): up to BLOCK_ROWS quantised vectors as int64 bytes; unusable vectors are left out."""
    def run(it):
        for batch in it:
            ids, vecs = batch.column("id"), batch.column("vec")
            ok = pc.and_(pc.is_valid(ids), pc.is_valid(vecs))
            ids, vecs = ids.filter(ok).to_numpy(), vecs.filter(ok)
            offs = vecs.offsets.to_numpy().astype(np.int64)
            flat = vecs.values.cast(pa.float64())
            x = np.nan_to_num(np.floor(SCALE * flat.fill_null(np.nan).to_numpy(zero_copy_only=False)), nan=np.inf, posinf=np.inf, neginf=np.inf)
            bad = np.append(0, np.cumsum(~np.isfinite(x)))
            dims = np.diff(offs)
            fine = bad[offs[1:]] == bad[offs[:-1]]
            x = np.clip(np.where(np.isfinite(x), x, 0), -2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)
            for d in np.unique(dims[fine]).tolist():
                for query in (False, True):
                    rows = np.flatnonzero(fine & (dims == d) & ((ids % modulus == 0) | (not query)))
                    for a in range(0, len(rows), BLOCK_ROWS):
                        at = rows[a:a + BLOCK_ROWS]
                        m = x[offs[at][:, None] + np.arange(d)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([d], pa.int32()), pa.array([query]), pa.array([len(at)], pa.int32()), pa.array([int(ids[at].min())], pa.int64()),
                            pa.array([ids[at].astype("<i8").tobytes()], pa.binary()), pa.array([m.astype("<i8").tobytes()], pa.binary())],
                            ["dim", "is_query", "n", "block", "ids", "rows"])

    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return src.mapInArrow(run, "dim int, is_query boolean, n int, block long, ids binary, rows binary")


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the long range they stop at its ends."""
    most = (max(int(np.abs(q).max()), 1) * max(int(np.abs(c).max()), 1) * q.shape[1]) if q.size and c.size and min(q.min(), c.min()) > -LONG else (0 if not (q.size and c.size) else LONG)
    if most < 2 ** 53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if most < LONG:
        return q @ c.T
    return np.clip(q.astype(object) @ c.T.astype(object), -LONG, LONG - 1).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best of each row: highest score, then smallest id; never the row's own id.

    Columns ascend by id, so that a stable choice keeps the smaller ids.
    """
    n = score.shape[1]
    same = ids[None, :] == own[:, None]
    spare = int(same.sum(axis=1).max()) if same.size else 0
    take = min(k + spare + n - len(np.unique(ids)), n)
    if take < n:
        least = np.partition(score, n - take, axis=1)[:, n - take]
        row, col = np.nonzero(score >= least[:, None])
    else:
        row, col = np.nonzero(np.ones_like(score, bool))
    keep = ~same[row, col]
    row, col = row[keep], col[keep]
    order = np.lexsort((col, -score[row, col], row))
    row, col = row[order], col[order]
    twin = np.zeros(len(row), bool)
    twin[1:] = (row[1:] == row[:-1]) & (ids[col[1:]] == ids[col[:-1]]) & (score[row[1:], col[1:]] == score[row[:-1], col[:-1]])
    row, col = row[~twin], col[~twin]
    start = np.searchsorted(row, np.arange(score.shape[0]))
    rank = np.arange(len(row)) - start[row]
    return row[rank < k], col[rank < k]


def top_k(vectors: DataFrame, k: int = 20, query_modulus: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of floor(64 * x) of every query, ties to smaller ids.

    Queries: rows whose id is divisible by ``query_modulus``; candidates: all rows with another id (all of
    them, if there are fewer than k) and the query's dimension. Null ids, null vectors and vectors with null
    or non-finite components take no part. Rows that repeat an id count once for each score that they get;
    a query id that is repeated with other vectors gets the best of all of them. Scores beyond the long range stop at its ends.
    An empty table gives no rows; other columns are not read.
    """
    blocks = materialize(_packed(vectors, id_col, vec_col, query_modulus), "vector-blocks")
    sizes = {r["is_query"]: r["n"] for r in blocks.groupBy("is_query").agg(F.sum("n").alias("n")).collect()}
    tasks = max(blocks.sparkSession.sparkContext.defaultParallelism, 1)
    # as square as can be, but never fewer cells than two per core unless the blocks are few
    side = lambda n: max(1, min(-(-n // BLOCK_ROWS), max(-(-n // cell_rows), 2 * tasks)))
    shards, slices = side(sizes.get(False, 0)), max(1, -(-sizes.get(True, 0) // cell_rows))
    # a block's bytes are its identity: equal blocks of repeated rows meet in one place and count once
    place = lambda n: F.pmod(F.xxhash64("ids", "rows"), F.lit(n)).cast("int")
    cand = blocks.filter("not is_query").withColumn("shard", place(shards)).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    quer = blocks.filter("is_query").withColumn("slice", place(slices)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # other names and new columns: a cogroup of two frames over one source mixes up equal columns
    quer = quer.select(*[(F.col(c) + 0).alias(f"q_{c}") for c in ("dim", "shard", "slice", "n")], *[F.concat(F.col(c)).alias(f"q_{c}") for c in ("ids", "rows")])

    def cell(key, left: pa.Table, right: pa.Table):
        if not left.num_rows or not right.num_rows:
            return pa.table({"shard": pa.array([], pa.int32()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        dim = key[0].as_py()
        unpack = lambda t, i, p: (np.frombuffer(t[p + "ids"][i].as_py(), "<i8"), np.frombuffer(t[p + "rows"][i].as_py(), "<i8").reshape(t[p + "n"][i].as_py(), dim))
        got = []
        for i in range(left.num_rows):
            ids, c = unpack(left, i, "")
            order = np.argsort(ids, kind="stable")
            ids, c = ids[order], c[order]
            for j in range(right.num_rows):
                own, q = unpack(right, j, "q_")
                for a in range(0, len(own), 512):
                    s = _scores(q[a:a + 512], c)
                    row, col = _best(s, ids, own[a:a + 512], k)
                    got.append((own[a:a + 512][row], ids[col], s[row, col]))
        query, vec, score = (np.concatenate(x) for x in zip(*got))
        return pa.table({"shard": pa.array(np.full(len(query), key[1].as_py(), np.int32)), "query_id": query, "vec_id": vec, "score": score})

    lists = cand.groupBy("dim", "shard", "slice").cogroup(quer.groupBy("q_dim", "q_shard", "q_slice")).applyInArrow(
        cell, "shard int, query_id long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    groups = shards
    while groups > 1:
        groups = -(-groups // FAN_IN)
        lists = lists.withColumn("shard", (F.col("shard") % groups).cast("int")).distinct()
        lists = (lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*order)))
                 .filter(F.col("rank") <= k).drop("rank"))
    out = lists.drop("shard").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return out.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
