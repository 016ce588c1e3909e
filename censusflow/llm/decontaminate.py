"""Benchmark decontamination by winnowing.

Both sides hash every k-gram of words and keep the smallest hash of each run of ``w`` neighbouring
k-grams (all of them on a tie), with ``w + k - 1`` = the window length. What a run keeps depends on its
words alone, so a document and an item that share a whole window share a kept fingerprint. Fingerprints
are joined on the hash; every hit is extended left and right, word by word, and counts if the common run
holds a window. An item shorter than the window is one window of its own length L: there k = L and w = 1.

A fixed-size Bloom filter of the item fingerprints keeps most document fingerprints from being shuffled;
it only prunes, the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .util import bloom_has, bloom_words, list_array, materialize, row_slices, string_buffer

WINDOW, GRAM = 13, 7


def _kept(h: np.ndarray, counts: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the k-grams that some run of ``w`` k-grams of one row keeps."""
    g, at, per_row = K.grams(h, counts, k)
    runs = len(g) - w + 1
    if w == 1 or runs <= 0:
        return (g, at) if w == 1 else (g[:0], at[:0])
    low = g[:runs].copy()
    for j in range(1, w):
        np.minimum(low, g[j:j + runs], out=low)
    row = np.repeat(np.arange(len(per_row)), per_row)
    whole = row[:runs] == row[w - 1:]
    keep = np.zeros(len(g), bool)
    for j in range(w):
        keep[j:j + runs] |= whole & (g[j:j + runs] == low)
    return g[keep], at[keep]


def _context(h: np.ndarray, counts: np.ndarray, at: np.ndarray, left: int, width: int, none: int) -> np.ndarray:
    """The ``width`` word hashes from ``left`` words before each place; ``none`` outside its row."""
    ends = np.cumsum(counts)
    row = np.searchsorted(ends, at, side="right")
    lo, hi = (ends - counts)[row], ends[row]
    idx = at[:, None] - left + np.arange(width)
    out = h[np.clip(idx, 0, max(len(h) - 1, 0))].view(np.int64).copy()
    out[(idx < lo[:, None]) | (idx >= hi[:, None])] = none
    return out


def _batches(it: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in it:
        buf, offs = string_buffer(batch.column(column))
        for i, j in row_slices(offs):
            yield batch.slice(i, j - i), *K.words(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], K.NOT_ALNUM)


def benchmark_fingerprints(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(item_id, h, len, ctx): kept fingerprints; ``len`` is the window's length, ``ctx`` the words about the k-gram."""
    left, width = window - gram, 2 * window - gram

    def run(it):
        for batch, h, counts in _batches(it, "text"):
            short = (counts < window) & (counts > 0)
            for n in [window, *np.unique(counts[short]).tolist()]:
                pick = counts == n if n < window else counts >= window
                own = counts[pick]
                mine = h[np.repeat(pick, counts)]
                g, at = _kept(mine, own, gram, window - gram + 1) if n == window else _kept(mine, own, n, 1)
                ids = np.flatnonzero(pick)[np.searchsorted(np.cumsum(own), at, side="right")]
                ctx = _context(mine, own, at, left, width, -2)
                yield pa.RecordBatch.from_arrays([
                    batch.column("item_id").take(pa.array(ids)), pa.array(g.view(np.int64)), pa.array(np.full(len(g), n, np.int32)),
                    list_array(ctx.ravel(), np.full(len(g), width), pa.int64())], ["item_id", "h", "len", "ctx"])

    src = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    return src.mapInArrow(run, f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, h long, len int, ctx array<long>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = 20) -> DataFrame:
    """One row per input row: (doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated).

    A document word inside any occurrence of an item's window is hit; contaminated: some word is hit and
    ``share * n_hit >= n_words``. ``text_key`` is xxhash64(text), so that callers can join rows back by
    (doc_id, text_key). Null or empty texts have no words; items without words or id match nothing; repeated
    rows (same id or text) each get a row of their own; other columns of ``docs`` are not read. Texts are read whole,
    however long. An empty ``docs`` gives no rows; against an empty benchmark nothing is hit.
    """
    left, width = window - gram, 2 * window - gram
    items = materialize(benchmark_fingerprints(benchmark, window, gram), "bench")
    bloom = docs.sparkSession.sparkContext.broadcast(bloom_words(items, "h"))
    lengths = sorted(r["len"] for r in items.select("len").distinct().collect())  # at most ``window`` values

    def run(it):
        row = (TaskContext.get().partitionId()) << 40
        for batch, h, counts in _batches(it, "text"):
            ends, found = np.cumsum(counts), []
            for n in lengths:
                g, at = _kept(h, counts, gram, window - gram + 1) if n == window else _kept(h, counts, n, 1)
                some = bloom_has(bloom.value, g)
                found.append((g[some], at[some], np.full(int(some.sum()), n, np.int32)))
            g, at, n = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32))
            of = np.searchsorted(ends, at, side="right")
            order = np.argsort(of, kind="stable")
            g, at, n, of = g[order], at[order], n[order], of[order]
            ctx = _context(h, counts, at, left, width, -1)
            place = at - (ends - counts)[of] if len(of) else at
            hits = pa.StructArray.from_arrays([pa.array(g.view(np.int64)), pa.array(n), pa.array(place),
                                               list_array(ctx.ravel(), np.full(len(g), width), pa.int64())], ["h", "len", "at", "ctx"])
            per_row = np.zeros(len(counts) + 1, np.int32)
            np.cumsum(np.bincount(of, minlength=len(counts)), out=per_row[1:])
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(len(counts))), batch.column("doc_id"), batch.column("text_key"), pa.array(counts),
                pa.ListArray.from_arrays(pa.array(per_row), hits)], ["uid", "doc_id", "text_key", "n_words", "hits"])
            row += len(counts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = materialize(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run, f"uid long, doc_id {kind}, text_key long, n_words long, hits array<struct<h:long,len:int,at:long,ctx:array<long>>>"), "words")
    hits = seen.filter("size(hits) > 0").select("uid", F.explode("hits").alias("d")).select("uid", "d.*")
    pairs = hits.join(items.select("item_id", "h", "len", F.col("ctx").alias("item")), ["h", "len"])
    same = F.zip_with("ctx", "item", lambda a, b: a == b)
    # words in common before the k-gram (nearest first) and from its first word on
    run_of = lambda eq: F.expr(f"aggregate({eq}, named_struct('n', 0, 'go', true), (s, x) -> named_struct('n', s.n + if(s.go and x, 1, 0), 'go', s.go and x), s -> s.n)")
    pairs = (pairs.withColumn("eq", same)
             .withColumn("back", run_of(f"reverse(slice(eq, 1, {left}))")).withColumn("ahead", run_of(f"slice(eq, {left + 1}, {width - left})"))
             .withColumn("back", F.when(F.col("len") < window, 0).otherwise(F.col("back")))
             .withColumn("ahead", F.when(F.col("len") < window, F.least("ahead", "len")).otherwise(F.col("ahead")))
             .filter(F.col("back") + F.col("ahead") >= F.col("len")))
    spans = pairs.select("uid", F.col("item_id").cast("string").alias("item_id"), F.struct((F.col("at") - F.col("back")).alias("s"), (F.col("at") + F.col("ahead")).alias("e")).alias("span"))
    per_doc = (spans.groupBy("uid").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("ids"))
               .select("uid", F.expr("aggregate(spans, named_struct('n', 0L, 'e', 0L), (a, x) -> named_struct('n', a.n + greatest(0L, x.e - greatest(x.s, a.e)), 'e', greatest(a.e, x.e)), a -> a.n)").alias("n_hit"),
                       F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))
    out = seen.select("uid", "doc_id", "text_key", "n_words").join(per_doc, "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))
