"""N-gram Jaccard join by group-count vectors.

Tokens (word shingles) are hashed into groups; a document is the point of its group counts. Two sets of
sizes p and q overlap by at most the sum of the coordinate minima, so a link needs
``sum min >= t / (1 + t) * (p + q)``: the points' L1 distance is at most ``T = (1 - t) / (1 + t) * (p + q)``.

The join is an R-tree over these points, cut so that Spark can deal it out:

* Inner level: the coordinates (64-bit groups here) have one order for all sets: those that stand in many sets come last,
  by group number otherwise. Sets that link share one of the first ``p - t * p + 1`` coordinates of either, so these are the
  keys. Which coordinates count as common (``_Repeats``) only decides how many sets meet under a key: any order finds all links.
* Under a key of at most ``FEW`` sets every pair is weighed: where the key is the first that they share, what follows it in
  either set has to suffice; then by the summed minima of its points, folded to few coordinates. Most chance meetings end here.
* A key of more sets is split by bands of set sizes. A pair lies in one band or in neighbouring ones, so a set is put into
  its own band and the next. In a band of more than ``FEW`` sets, every set is tied to the smallest one.
* Sets connected by these ties form a cluster: a superset of linked sets. In a cluster of more than ``TILE``
  sets all folded points are compared first, in tiles, and it falls apart along the pairs that may link.
  Members are dealt to tiles of at most ``2 * TILE`` (each two blocks of a large cluster meet in one).
* Leaves: in a tile an R-tree is packed over the full count vectors; node and point bounds by summed minima
  prune, and the sets of surviving pairs are intersected. Pairs that links already connect are not tested.

Equal sets are one class before all this: copies add rows to a group-by, not pairs.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .graph import components
from .util import binary_array, bloom_has, bloom_words, discard, list_array, materialize, materialize_narrow, row_slices, string_buffer

TILE, LEAF, FEW, POINT_TILE = 384, 16, 128, 4096
#: Shingles that a task counts at once, and sets from which on a shingle is common.
COUNTED, COMMON = 1 << 21, 16


def shingle_sets(buf: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each row, and their number by row.

    A row of fewer than ``n`` words is one shingle, a row without words has none.
    """
    h, counts = K.words(buf, offs, K.SPACE)
    rows = np.arange(len(counts))
    row_of_word = np.repeat(rows, counts)
    g, at, per = K.grams(h, counts, n)
    gs, rs = [g], [np.repeat(rows, per)]
    for k in range(1, n):
        pick = counts == k
        if pick.any():
            short, _, per = K.grams(h[pick[row_of_word]], counts[pick], k)
            gs.append(short)
            rs.append(np.repeat(rows[pick], per))
    g, r = np.concatenate(gs), np.concatenate(rs)
    if len(gs) > 1:
        order = np.argsort(r, kind="stable")
        g, r = g[order], r[order]
    ends = np.cumsum(np.bincount(r, minlength=len(counts)))
    for i, j in zip([0, *ends.tolist()], ends.tolist()):  # short runs: faster than one sort by row and hash
        g[i:j].sort()
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    return g[first], np.bincount(r[first], minlength=len(counts))


def set_ids(g: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One 64-bit id per set, whatever the order of its members."""
    run = np.zeros(len(g) + 1, np.uint64)
    np.cumsum(K.mix(g ^ np.uint64(0xA0761D6478BD642F)), out=run[1:])
    ends = np.cumsum(counts)
    return K.mix(run[ends] - run[ends - counts] + counts.astype(np.uint64)).view(np.int64)


@lru_cache(maxsize=8)
def bands(num: int, den: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """First size of each band (up to ``largest`` and one more), and its largest distance T."""
    edges = [1]
    while edges[-1] <= largest or len(edges) < 3:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * den // num)))
    edges.append(max(edges[-1] + 1, -(-edges[-1] * den // num)))
    e = np.array(edges, np.int64)
    return e[:-1], 2 * (e[1:] - 1) * (den - num) // (den + num)


def first_keys(g: np.ndarray, counts: np.ndarray, common: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set, by the order that puts ``common`` ones last, and their number by row.

    Sets of sizes p and q that link overlap by ``num / den`` of either at least. So the first shingle that they share
    has as many after it in both, itself included, and is among the first ``p - num * p / den + 1`` of each.
    """
    n = len(counts)
    row, first = np.repeat(np.arange(n), counts), np.cumsum(counts) - counts
    rare = np.zeros(len(g) + 1, np.int64)
    np.cumsum(~common, out=rare[1:])
    before = rare[:-1] - rare[first][row]  # the row's rare ones before each
    held = (rare[first + counts] - rare[first])[row]
    at = np.where(common, held + np.arange(len(g)) - first[row] - before, before)
    wanted = np.where(counts > 0, counts + counts * num // -den + 1, 0)
    keep = at < wanted[row]
    keys = np.empty(int(wanted.sum()), np.uint64)
    keys[(np.cumsum(wanted) - wanted)[row[keep]] + at[keep]] = g[keep]
    return keys.view(np.int64), wanted


class _Repeats:
    """Shingles that more than one set of a task has, counted ``COUNTED`` at a time: a shingle of very many sets shows in every task."""

    def __init__(self):
        self.held: list[np.ndarray] = []

    def add(self, g: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Values and counts, whenever enough have come together."""
        self.held.append(g)
        return self.end() if sum(map(len, self.held)) >= COUNTED else []

    def end(self) -> list[tuple[np.ndarray, np.ndarray]]:
        g, self.held = np.sort(np.concatenate([*self.held, np.empty(0, np.uint64)])), []
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1])[:len(g)])
        times = np.diff(np.append(first, len(g)))
        return [(g[first[times > 1]], times[times > 1])] if (times > 1).any() else []


def folded_points(g: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set's group counts in 64, 256 or 1024 coordinates (by its size) of a byte, and their number by row.

    Where a count is over 255, the row's counts are rounded up to units of a power of two, whose exponent is
    the last byte: sums of minima then only get larger, and stay a bound.
    """
    n = len(counts)
    dims = np.where(counts <= 1000, 64, np.where(counts <= 5000, 256, 1024))
    first = np.cumsum(dims) - dims
    row = np.repeat(np.arange(n), counts)
    slot = first[row] + ((g >> np.uint64(20)) & (dims[row] - 1).astype(np.uint64)).astype(np.int64)
    held = np.bincount(slot, minlength=int(dims.sum()))
    most = np.maximum.reduceat(held, first) if n else held[:0]
    unit = np.ceil(np.log2(np.maximum(-(-most // 255), 1))).astype(np.int64)
    small = -(-held // (1 << np.repeat(unit, dims)))
    out = np.empty(int(dims.sum()) + n, np.uint8)
    end = np.cumsum(dims + 1) - 1
    own = np.ones(len(out), bool)
    own[end] = False
    out[own], out[end] = small, unit
    return out, dims + 1


def may_link(a: bytes, b: bytes, p: int, q: int, num: int, den: int) -> bool:
    """Whether sets of sizes p and q with these folded points can reach the similarity."""
    if p * den < q * num or q * den < p * num:
        return False
    x, y = (np.frombuffer(v, np.uint8)[:-1].astype(np.int64) << v[-1] for v in (a, b))
    if len(x) > len(y):
        x, y = y, x
    if len(x) < len(y):
        y = y.reshape(-1, len(x)).sum(axis=0)
    return (num + den) * int(np.minimum(x, y).sum()) >= num * (p + q)


def point_links(points: list[bytes], size: np.ndarray, num: int, den: int, ask: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that connect all members whose folded points may link, directly or not (see ``may_link``)."""
    dims = np.array([len(p) - 1 for p in points])
    levels = {}
    for d in np.unique(dims).tolist():  # points folded to d coordinates, of all that have as many
        rows = np.flatnonzero(dims >= d)
        levels[d] = np.zeros((len(points), d), np.int32)
        for k in rows.tolist():
            levels[d][k] = (np.frombuffer(points[k], np.uint8)[:-1].astype(np.int32) << points[k][-1]).reshape(-1, d).sum(axis=0)
    comp, links = np.arange(len(points)), []
    for x in range(len(points)) if ask is None else np.flatnonzero(ask).tolist():
        p = int(size[x])
        near = np.flatnonzero((comp != comp[x]) & (size * den >= p * num) & (size * num <= p * den))
        for d, m in levels.items():
            y = near[np.minimum(dims[near], dims[x]) == d]
            y = y[(num + den) * np.minimum(m[y], m[x]).sum(axis=1) >= num * (p + size[y])]
            y = y[np.unique(comp[y], return_index=True)[1]]  # one of each group
            if len(y):
                links += [(x, int(k)) for k in y]
                comp[np.isin(comp, comp[y])] = comp[x]
    return links


class _Found:
    """Union of linked members of a tile."""

    def __init__(self, n: int):
        self.comp = np.arange(n)

    def join(self, a: int, b: int) -> None:
        x, y = self.comp[a], self.comp[b]
        self.comp[self.comp == max(x, y)] = min(x, y)


def tile_links(sets: list[np.ndarray], num: int, den: int, ask: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all members whose Jaccard similarity is ``num / den`` or more, directly or not.

    ``ask``: members whose pairs are wanted (all others are only found by them).
    """
    size = np.array([len(s) for s in sets])
    groups = 1 << int(np.clip(np.ceil(np.log2(max(size.max(initial=1), 1))), 6, 11))
    points = np.zeros((len(sets), groups), np.int32)
    for k, s in enumerate(sets):
        points[k] = np.bincount((s >> np.uint64(40)) & np.uint64(groups - 1), minlength=groups)
    # packed tree: leaves of neighbours by size, then by the fullest coordinates
    order = np.lexsort((points.argmax(axis=1), size))
    leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
    top = np.array([points[leaf].max(axis=0) for leaf in leaves]).reshape(len(leaves), groups)
    small, big = np.array([size[leaf].min() for leaf in leaves]), np.array([size[leaf].max() for leaf in leaves])
    found, links = _Found(len(sets)), []
    for x in order if ask is None else order[ask[order]]:
        p, c = int(size[x]), points[x]
        if not p:
            continue
        fits = (big * den >= p * num) & (small * num <= p * den)
        fits[fits] = (num + den) * np.minimum(top[fits], c).sum(axis=1) >= num * (p + small[fits])
        near = np.concatenate([leaves[k] for k in np.flatnonzero(fits)]) if fits.any() else order[:0]
        near = near[(found.comp[near] != found.comp[x]) & (size[near] * den >= p * num) & (size[near] * num <= p * den)]
        near = near[(num + den) * np.minimum(points[near], c).sum(axis=1) >= num * (p + size[near])]
        while len(near):
            y = near[0]
            both = np.intersect1d(sets[x], sets[y], assume_unique=True).size
            if (num + den) * both >= num * (p + int(size[y])):
                links.append((int(x), int(y)))
                found.join(x, y)
                near = near[found.comp[near] != found.comp[x]]
            else:
                near = near[1:]
    return links


def _over_sets(n: int, run, pick=None, end=None):
    """A mapInArrow function: the batches of ``run(rows, sets, counts, task)`` for each slice of texts (of rows that ``pick(batch)``
    marks), then those of ``end(task)``. ``task`` lives as long as the task."""
    def over(it):
        task = _Task()
        for batch in it:
            if pick is not None:
                batch = batch.filter(pa.array(pick(batch)))
            buf, offs = string_buffer(batch.column("text"))
            for i, j in row_slices(offs):
                yield from run(batch.slice(i, j - i), *shingle_sets(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], n), task)
        if end is not None:
            yield from end(task)
    return over


class _Task:
    """Ids of the sets that a task has met, and its repeated shingles."""

    def __init__(self):
        self.seen: set[int] = set()
        self.repeats = _Repeats()

    def new(self, ids: np.ndarray, counts: np.ndarray, doc_id: pa.Array) -> np.ndarray:
        """Sets of documents with an id that are met for the first time."""
        out = np.zeros(len(counts), bool)
        for k, s in enumerate(ids.tolist()):
            out[k] = counts[k] > 0 and s not in self.seen and doc_id[k].is_valid
            if out[k]:
                self.seen.add(s)
        return out


def jaccard_components(docs: DataFrame, shingle: int = 3, num: int = 9, den: int = 10, row_keys: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: rows link when ``den * |a & b| >= num * |a | b|``.

    With ``row_keys`` also text_key, the text's xxhash64, and group_key, one value for each component: ids may repeat with other texts.

    Words are split at ASCII white space and A-Z is lower-cased. component_id is the smallest doc_id that
    links reach, the row's own included. A null or empty text has no shingles and links with nothing; a null
    doc_id is no partner and has a null component_id. Rows that repeat a doc_id are one document each with
    that id. Very long texts are read whole, in slices of their own; a text's set is one row. An empty table gives no
    rows. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))

    names = ["doc_id", "n_shingles", "sig", "point", "text_key", "common", "times"]

    def repeated(found):
        for g, times in found:  # a row of its own
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())),
                                              *(list_array(x.view(np.int64), np.array([len(x)]), pa.int64()) for x in (g, times))], names)

    def size(batch, g, counts, task):
        ids = set_ids(g, counts)
        none = pa.nulls(len(counts), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(ids), binary_array(*folded_points(g, counts)), batch.column("text_key"), none, none], names)
        yield from repeated(task.repeats.add(g[np.repeat(task.new(ids, counts, batch.column("doc_id")), counts)]))

    sized = docs.mapInArrow(_over_sets(shingle, size, end=lambda task: repeated(task.repeats.end())),
                            "doc_id long, n_shingles long, sig long, point binary, text_key long, common array<long>, times array<long>")
    sized = materialize(sized, "sets")
    seen = sized.filter("common is null").drop("common", "times")
    counted = sized.filter("common is not null").select(F.explode(F.arrays_zip("common", "times")).alias("c")).select("c.*")
    counted = materialize_narrow(counted.groupBy("common").agg(F.sum("times").alias("n")).filter(F.col("n") > COMMON), "common")
    common = docs.sparkSession.sparkContext.broadcast(bloom_words(counted, "common"))
    held = seen.filter("n_shingles > 0 and doc_id is not null")
    classes = materialize_narrow(held.groupBy("sig").agg(F.min(F.struct("doc_id", "n_shingles", "point")).alias("r"))
                                 .select("sig", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"), "r.point"), "classes")

    def keyed(batch, g, counts, task):
        ids = set_ids(g, counts)
        new = task.new(ids, counts, batch.column("doc_id"))  # a task sends a set's keys once
        g, counts = g[np.repeat(new, counts)], counts[new]
        yield pa.RecordBatch.from_arrays([pa.array(ids[new]), pa.array(counts), list_array(*first_keys(g, counts, bloom_has(common.value, g), num, den), pa.int64())], ["sig", "n", "keys"])

    # Keys are made anew from the texts and go straight into the shuffle: written, they would take as much
    # disk as the texts. A set's size and the key's place in it go as one number.
    rows = docs.select("doc_id", "text").mapInArrow(_over_sets(shingle, keyed), "sig long, n long, keys array<long>").select("sig", "n", F.posexplode("keys").alias("at", "key"))
    rows = rows.select("key", "sig", (F.shiftleft("n", 32) + F.col("at")).alias("place"))
    rows = rows.withColumn("k", F.count("*").over(Window.partitionBy("key"))).filter("k > 1").select("key", "sig", "place").distinct()
    rows = rows.withColumn("k", F.count("*").over(Window.partitionBy("key"))).filter("k > 1").withColumn("n", F.shiftright("place", 32))
    edges = bands(num, den, 1 << 40)[0].tolist()
    band = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("n")))
    rows = rows.withColumn("band", F.explode(F.when(F.col("k") > FEW, F.array(band, band + 1)).otherwise(F.array(F.lit(0)))))
    under = Window.partitionBy("key", "band").orderBy("sig")
    rows = rows.withColumn("k", F.count("*").over(under.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    pivot = F.min("sig").over(under.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.collect_list(F.struct("sig", "place")).over(under.rowsBetween(1 - FEW, -1))
    met = rows.select("sig", "place", "n", (F.col("k") <= FEW).alias("few"), F.when(F.col("k") <= FEW, before).otherwise(F.array(F.struct(pivot.alias("sig"), "place"))).alias("a"))
    met = met.select(F.explode("a").alias("a"), F.col("sig").alias("b"), "place", "n", "few").filter("a.sig <> b")
    left = lambda place: F.shiftright(place, 32) - F.col(place).bitwiseAND((1 << 32) - 1)  # noqa: E731  the key and what follows it
    suffices = (num + den) * F.least(left("a.place"), left("place")) >= num * (F.shiftright("a.place", 32) + F.col("n"))
    met = met.filter(~F.col("few") | suffices).select("a.sig", "b", "few").toDF("a", "b", "few").groupBy("a", "b").agg(F.min("few").alias("few"))
    met = materialize(met, "met")

    def weigh(it):
        for batch in it:
            cols = [batch.column(c).to_pylist() for c in ("pa", "pb", "na", "nb")]
            keep = pa.array([may_link(*x, num, den) for x in zip(*cols)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    point_of = lambda c: classes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}"))
    weighed = met.filter("few").join(point_of("a"), "a").join(point_of("b"), "b").select("a", "b", "pa", "pb", "na", "nb").mapInArrow(weigh, "a long, b long")
    ties = met.filter("not few").select("a", "b").unionByName(weighed)
    clusters = materialize_narrow(components(ties, "clusters").withColumnRenamed("node", "sig"), "clusters")
    sizes = materialize_narrow(clusters.groupBy("comp").agg(F.count("*").alias("c")), "cluster-sizes")

    # large clusters fall apart along the pairs whose folded points may link
    large = (clusters.join(sizes.filter(F.col("c") > TILE), "comp").join(classes.select("sig", "n", "point"), "sig")
             .withColumn("blocks", F.ceil(F.col("c") / POINT_TILE).cast("int")).withColumn("block", F.pmod(F.xxhash64(F.lit(7), "sig"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))))
    large = large.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sig", "n", "point")

    def apart(key, table):
        sig, size = table["sig"].to_numpy(), table["n"].to_numpy()
        ask = None if key[1].as_py() == key[2].as_py() else table["block"].to_numpy() == key[1].as_py()
        found = point_links(table["point"].to_pylist(), size, num, den, ask)
        a, b = (np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
        return pa.table({"a": sig[a], "b": sig[b]})

    parts = components(materialize(large.groupBy("comp", "i", "j").applyInArrow(apart, "a long, b long"), "near-points"), "parts")
    small = clusters.join(sizes.filter(F.col("c") <= TILE).select("comp"), "comp", "left_semi").select("sig", "comp")
    whole = materialize_narrow(small.unionByName(parts.select(F.col("node").alias("sig"), "comp")), "clusters")
    for old in (met, clusters, sizes, counted):
        discard(old)
    clusters = whole

    # tiles of clusters
    sizes = clusters.groupBy("comp").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    members = (clusters.join(materialize_narrow(sizes, "cluster-sizes"), "comp").join(classes.select("sig", "rep"), "sig")
               .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "sig"), F.col("blocks")).cast("int")))
    members = materialize_narrow(members, "members")
    wanted = docs.sparkSession.sparkContext.broadcast(bloom_words(members, "sig"))
    reps = docs.sparkSession.sparkContext.broadcast(bloom_words(members.select(F.xxhash64("rep").alias("rep")), "rep"))

    def again(batch, g, counts, task):
        ids = set_ids(g, counts)
        keep = bloom_has(wanted.value, ids) & (counts > 0)
        own = g[np.repeat(keep, counts)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(pa.array(keep)), pa.array(ids[keep]), binary_array(own.view(np.uint8), counts[keep] * 8)], ["rep", "sig", "set"])

    of_rep = lambda batch: bloom_has(reps.value, batch.column("rep_key").to_numpy())
    sets = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("rep_key")).mapInArrow(_over_sets(shingle, again, of_rep), "rep long, sig long, set binary")
    placed = members.join(sets, ["sig", "rep"]).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sig", "set")

    def tile(key, table):
        sig, pick = np.unique(table["sig"].to_numpy(), return_index=True)
        sets_ = [np.frombuffer(table["set"][int(k)].as_py(), np.uint64) for k in pick]
        i, j = key[1].as_py(), key[2].as_py()
        # a tile of two blocks asks for the pairs of the first one's members
        links = tile_links(sets_, num, den, None if i == j else table["block"].to_numpy()[pick] == i)
        a, b = (np.array(x, np.int64) for x in zip(*links)) if links else (np.empty(0, np.int64), np.empty(0, np.int64))
        return pa.table({"a": sig[a], "b": sig[b]})

    links = materialize(placed.groupBy("comp", "i", "j").applyInArrow(tile, "a long, b long"), "links")
    groups = components(links, "groups").withColumnRenamed("node", "sig").join(classes.select("sig", "rep"), "sig")
    low = materialize_narrow(groups.groupBy("comp").agg(F.min("rep").alias("low")), "group-ids")
    linked = materialize_narrow(groups.join(low, "comp").select("sig", "low", "comp"), "groups")
    of = materialize_narrow(classes.select("sig", "rep").join(linked, "sig", "left").select(
        "sig", F.coalesce("low", "rep").alias("component_id"), F.coalesce("comp", "sig").alias("group_key")), "class-ids")
    for old in (members, links, clusters):
        discard(old)
    columns = ["doc_id", "n_shingles", "component_id", *(["text_key", "group_key"] if row_keys else [])]
    alone = seen.filter("n_shingles = 0 or doc_id is null").withColumns({"component_id": F.col("doc_id"), "group_key": F.lit(None).cast("long")})
    return held.join(of, "sig").select(columns).unionByName(alone.select(columns))

