"""Ranked lexical search: dense blocked products of item vocabularies and document impacts.

Items are dealt into tiles. A tile's distinct terms are its vocabulary. One pass over the texts keeps, of every
document, the counts of the tile's terms, and counts N, L and the document frequencies beside them. A second pass
makes matrices of tiles: documents x terms (impacts) times terms x items (weights), in float64. Impacts are below
10**6 and weights below 45,000, so a partial sum over ``TERM_TILE`` terms stays below 2**53 and is exact; partial
sums are added in 64-bit integers. A task keeps the best of each item as it goes; their lists merge in two steps.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import NOT_ALNUM, words
from .util import binary_array, materialize, row_slices, string_buffer

ITEM_TILE, TERM_BOUND = 1024, 1 << 20
TERM_TILE, DOC_TILE = 8192, 512
_DENSE, _PENDING = 1 << 23, 1 << 17
_BLOCK = "ids binary, n binary, per binary, cols binary, tf binary, term array<int>, df array<long>, n_docs long, n_terms long"


def _terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term): the hashed distinct terms of every item; rows that repeat an id are one item."""
    def run(it):
        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            buf, offs = string_buffer(batch.column(1))
            h, counts = words(buf, offs, NOT_ALNUM)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts).astype(np.int64)), pa.array(h.view(np.int64))], ["item_id", "term"])

    src = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "item_id long, term long").distinct()


def _counted(docs: DataFrame, voc: np.ndarray) -> DataFrame:
    """Blocks of documents with the counts of the vocabulary's terms, and a row of statistics from each task."""
    size = len(voc)

    def run(it):
        df = np.zeros(size, np.int64)
        n_docs = n_terms = 0
        for batch in it:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            buf, offs = string_buffer(batch.column(1))
            for i, j in row_slices(offs):
                h, counts = words(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], NOT_ALNUM)
                n_docs += int((counts > 0).sum())
                n_terms += len(h)
                at = np.minimum(np.searchsorted(voc, h), size - 1)
                hit = voc[at] == h
                key, tf = np.unique(np.repeat(np.arange(j - i), counts)[hit] * size + at[hit], return_counts=True)
                row, col = key // size, key % size
                df += np.bincount(col, minlength=size)
                ours = known[i:j][row]
                row, col, tf = row[ours], col[ours], tf[ours]
                per = np.bincount(row, minlength=j - i)
                held = np.flatnonzero(per)
                if len(held):
                    fields = (ids[i:j][held].astype("<i8"), counts[held].astype("<i8"), per[held].astype("<i8"), col.astype("<i4"), tf.astype("<i8"))
                    yield pa.RecordBatch.from_arrays([*(binary_array(x.view(np.uint8), np.array([x.nbytes])) for x in fields),
                                                      *(pa.nulls(1, t) for t in (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int64()))], names)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.binary()) for _ in range(5)), pa.array([some.tolist()], pa.list_(pa.int32())),
                                          pa.array([df[some].tolist()], pa.list_(pa.int64())), pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names)

    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return docs.mapInArrow(run, _BLOCK)


def _impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 20 * m), m = 50 + (50 * n * N) div L."""
    if 50 * int(n.max()) * n_docs < 2 ** 63:
        m = 50 + 50 * n * n_docs // n_terms
    else:
        m = np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()])
    return 10 ** 9 * tf // (1000 * tf + 20 * m)


def _first(item: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each item's k best, by item, score falling, document rising."""
    order = np.lexsort((doc, -score, item))
    start = np.searchsorted(item[order], item[order])
    return order[np.arange(len(order)) - start < k]


def _scored(blocks: DataFrame, term: np.ndarray, item: np.ndarray, weight: np.ndarray, ids: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(task, item_id, doc_id, score): each task's k best documents of every item. ``term`` (sorted) and ``item`` pair up."""
    n_items, size = len(ids), len(weight)

    def weights(cols: np.ndarray) -> np.ndarray:
        out = np.zeros((len(cols), n_items))
        lo, hi = np.searchsorted(term, cols), np.searchsorted(term, cols, side="right")
        at = np.repeat(np.arange(len(cols)), hi - lo)
        pair = np.arange(len(at)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        out[at, item[pair]] = weight[cols[at]]
        return out

    def run(it):
        whole = weights(np.arange(size)) if size * n_items <= _DENSE else None
        best = [np.empty(0, np.int64)] * 3
        least = np.ones(n_items, np.int64)
        pending: list[tuple[np.ndarray, ...]] = []

        def merge():
            nonlocal best
            best = [np.concatenate(x) for x in zip(best, *pending)]
            best = [x[_first(*best, k)] for x in best]
            pending.clear()
            full = np.flatnonzero(np.bincount(best[0], minlength=n_items) == k)
            last = np.searchsorted(best[0], full, side="right") - 1
            least[full] = best[2][last]

        for batch in it:
            for r in range(batch.num_rows):
                doc, n, per, col, tf = (np.frombuffer(batch.column(c)[r].as_py(), t) for c, t in enumerate(("<i8", "<i8", "<i8", "<i4", "<i8")))
                ends = np.append(0, np.cumsum(per))
                for a in range(0, len(doc), DOC_TILE):
                    b = min(a + DOC_TILE, len(doc))
                    here = slice(ends[a], ends[b])
                    row = np.repeat(np.arange(b - a), per[a:b])
                    value, at = _impacts(tf[here], n[a:b][row], n_docs, n_terms), col[here]
                    present = np.unique(at)
                    total = np.zeros((b - a, n_items), np.int64)
                    for c in range(0, len(present), TERM_TILE):
                        cols = present[c:c + TERM_TILE]
                        mine = (at >= cols[0]) & (at <= cols[-1])
                        tile = np.zeros((b - a, len(cols)))
                        tile[row[mine], np.searchsorted(cols, at[mine])] = value[mine]
                        total += (tile @ (weights(cols) if whole is None else whole[cols])).astype(np.int64)
                    d, i = np.nonzero(total >= least)
                    pending.append((i, doc[a + d], total[d, i]))
                    if sum(len(x[0]) for x in pending) > _PENDING:
                        merge()
        merge()
        yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]], pa.int64()), pa.array(best[1], pa.int64()), pa.array(best[2], pa.int64())], ["item_id", "doc_id", "score"])

    src = blocks.filter("ids is not null").select("ids", "n", "per", "cols", "tf")
    return src.mapInArrow(run, "item_id long, doc_id long, score long").withColumn("task", F.spark_partition_id())


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", item_tile: int = ITEM_TILE) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of each item with the highest score above 0, ties to smaller doc_id.

    Terms, weights and impacts as in the module's text; N, L and document frequencies count all documents. Terms are
    told apart by 64-bit hashes. Null and empty texts have no terms. Items without an id or without terms that stand in a document
    get no rows. Rows that repeat an item id are one item with the terms of all of them. Every row of documents is a
    document: rows that repeat a doc_id are ranked one by one. Documents without an id count in the statistics and are never
    returned. Very long texts are read whole, in slices of their own; a text's counts are one row. Empty tables: no
    rows. Other columns are not read. A tile of items reads the texts once; ``TERM_BOUND`` bounds the vocabulary that the tasks get.
    """
    spark = docs.sparkSession
    pairs = materialize(_terms(items, item_id_col, item_text_col), "item-terms")
    size = pairs.agg(F.countDistinct("item_id").alias("items"), F.count("*").alias("terms")).first()
    tiles = max(-(-size["items"] // item_tile), -(-size["terms"] // TERM_BOUND))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "item_id long, rank int, doc_id long, score long"
    found = []
    for t in range(tiles):
        tile = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(tiles)) == t).toArrow()
        if not tile.num_rows:
            continue
        voc, term = np.unique(tile["term"].to_numpy().view(np.uint64), return_inverse=True)
        ids, item = np.unique(tile["item_id"].to_numpy(), return_inverse=True)
        order = np.argsort(term, kind="stable")
        blocks = materialize(_counted(src, voc), "term-counts")
        stats = blocks.filter("n_docs is not null")
        n = stats.agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t"), F.count("*").alias("tasks")).first()
        if not n["t"]:
            continue
        df = np.zeros(len(voc), np.int64)
        seen = (stats.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy(F.col("x.term").alias("term")).agg(F.sum("x.df").alias("df"))).toArrow()
        df[seen["term"].to_numpy()] = seen["df"].to_numpy()
        weight = np.array([math.floor(1000 * math.log((2 * n["d"] + 2) / (2 * x + 1))) for x in df.tolist()], float)
        lists = _scored(blocks, term[order], item[order], weight, ids, n["d"], n["t"], k)
        rank = lambda *by: F.row_number().over(Window.partitionBy("item_id", *by).orderBy(F.desc("score"), F.asc("doc_id")))
        # a tree of two levels: about the square root of the number of tasks meet in each node
        shards = max(1, math.isqrt(n["tasks"]))
        lists = lists.withColumn("shard", F.pmod("task", F.lit(shards))).withColumn("rank", rank("shard")).filter(F.col("rank") <= k)
        top = lists.withColumn("rank", rank()).filter(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found.append(top if tiles == 1 else materialize(top, "ranked"))
    out = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def duckdb_sql(k: int = 50) -> str:
    """DuckDB SQL for ``search`` over ``documents`` and ``benchmark``."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = f"unnest(regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT r, doc_id, {terms} AS term FROM rows),
n AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM n),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT q.item_id, q.term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM q JOIN df USING (term), s),
p AS (SELECT w.item_id, n.r, n.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * n.n * big_n) // big_l)))) AS BIGINT) AS score
      FROM w JOIN tf USING (term) JOIN n USING (r), s WHERE n.doc_id IS NOT NULL GROUP BY w.item_id, n.r, n.doc_id),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {k}
"""
