import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from censusflow.llm import ngram_join
from censusflow.llm.graph import components
from censusflow.llm.ngram_join import bands, jaccard_components, tile_links

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n, num, den):
    sets = []
    for i, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(max(len(w) - n + 1, 1))) if w else frozenset())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    index = defaultdict(list)
    for k, s in enumerate(sets):
        seen = Counter(j for g in s for j in index[g] if rows[k][0] is not None)
        for j, both in seen.items():
            if den * both >= num * (len(s) + len(sets[j]) - both):
                comp[find(k)] = find(j)
        if rows[k][0] is not None:
            for g in s:
                index[g].append(k)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low[find(k)] if i is not None else None) for k, (i, _) in enumerate(rows)), key=repr)


def corpus(rng, n_words, copies, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(n_words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[], [f"w{rng.randrange(3000)}"], [w[k], "extra"]])
        out.append(" ".join(w))
    return out


def check(spark, rows, n=3, num=9, den=10):
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, sig int, rep int").repartition(4)
    got = sorted((tuple(r) for r in jaccard_components(df, n, num, den).collect()), key=repr)
    assert got == brute(rows, n, num, den)


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 8, 10)])
def test_against_brute_force(spark, n, num, den):
    rng = random.Random(8)
    texts = []
    for size, copies, edits in ((3, 6, 1), (12, 12, 2), (40, 12, 4), (90, 14, 6), (300, 10, 20), (1500, 5, 60)):
        for _ in range(3):
            texts += corpus(rng, size, copies, edits)
    texts += ["one", "One", "two words", "two  WORDS", "", None, "  ", "a " * 2000, "a " * 2001]
    rng.shuffle(texts)
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    rows += [(None, texts[0]), rows[3], (rows[4][0], "another text with this id"), (5000, rows[7][1])]
    check(spark, rows, n, num, den)


def test_hot_cluster_is_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 16)
    monkeypatch.setattr(ngram_join, "POINT_TILE", 24)
    rng = random.Random(3)
    check(spark, [(k, t) for k, t in enumerate(corpus(rng, 120, 150, 5) + corpus(rng, 80, 40, 6))])


def test_empty(spark):
    check(spark, [])


def test_bands_bound_the_distance():
    for num, den in ((9, 10), (8, 10), (1, 2)):
        edges, distance = bands(num, den, 500)
        band = lambda n: int(np.searchsorted(edges, n, side="right")) - 1
        for big in range(1, 400):
            for small in range(-(-num * big // den), big + 1):
                assert band(big) - band(small) in (0, 1)
                both = -(-num * (big + small) // (num + den))
                assert big + small - 2 * both <= distance[band(big)]


def test_tile_finds_all_links():
    rng = np.random.default_rng(5)
    pool = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(1, 30), replace=False)) for _ in range(20)]
    sets += [np.sort(np.append(s[1:], rng.choice(pool, 1))) for s in sets for _ in range(3)]
    sets = [np.unique(s) for s in sets]
    got = tile_links(sets, 8, 10)
    group = list(range(len(sets)))
    for a, b in got:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both)
        group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both) and both:
                assert group[a] == group[b]


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(len(want)):
        before = dict(want)
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
        if before == want:
            break
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_folded_points_never_hide_a_link():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64))
    for size in (5, 60, 990, 1010, 4900, 30_000):
        for _ in range(6):
            a = np.sort(rng.choice(pool, size, replace=False))
            b = np.unique(np.concatenate([a[rng.random(size) < 0.93], rng.choice(pool, max(size // 20, 1))]))
            (raw, n), num, den = ngram_join.folded_points(np.concatenate([a, b]), np.array([len(a), len(b)])), 8, 10
            pa_, pb = raw[:n[0]].tobytes(), raw[n[0]:].tobytes()
            both = len(np.intersect1d(a, b))
            if den * both >= num * (len(a) + len(b) - both):
                assert ngram_join.may_link(pa_, pb, len(a), len(b), num, den)
    same = np.full(70_000, pool[0])  # one coordinate holds all: units
    raw, n = ngram_join.folded_points(same, np.array([len(same)]))
    assert ngram_join.may_link(raw.tobytes(), raw.tobytes(), len(same), len(same), 9, 10)


def test_point_links_keep_what_may_link():
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 1 << 63, 9000, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (30, 200, 990, 1015, 4000)]
    sets = [np.unique(np.append(s[rng.random(len(s)) < 0.95], rng.choice(pool, 1 + len(s) // 40))) for s in sets for _ in range(8)]
    size = np.array([len(s) for s in sets])
    raw, n = ngram_join.folded_points(np.concatenate(sets), size)
    ends = np.cumsum(n)
    points = [raw[e - k:e].tobytes() for e, k in zip(ends, n)]
    for ask in (None, np.arange(len(sets)) % 2 == 0):
        got = ngram_join.point_links(points, size, 8, 10, ask)
        group = np.arange(len(sets))
        for a, b in got:
            assert ngram_join.may_link(points[a], points[b], int(size[a]), int(size[b]), 8, 10)
            group[group == group[b]] = group[a]
        for a in range(len(sets)):
            for b in range(len(sets)):
                if a != b and (ask is None or ask[a]) and ngram_join.may_link(points[a], points[b], int(size[a]), int(size[b]), 8, 10):
                    assert group[a] == group[b]


def test_common_passages_do_not_cluster_sets(spark, monkeypatch):
    """Documents that share a passage, but are no copies, are not tied to each other: a tie of all grows with the square of the table."""
    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(120)) + " " + passage) for k in range(400)]
    rows += [(1000 + k, rows[k][1] + " end") for k in range(0, 40, 4)]
    tied = []

    def counted(edges, name):
        tied.append(edges.count())
        return components(edges, name)

    monkeypatch.setattr(ngram_join, "components", counted)
    check(spark, rows, 5, 8, 10)
    assert tied[0] <= 40


@pytest.mark.parametrize("few,common,counted", [(3, 16, 50), (3, 10**6, 1 << 21), (128, 2, 7)])
def test_keys_of_many_sets(spark, monkeypatch, few, common, counted):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "COMMON", common)
    monkeypatch.setattr(ngram_join, "COUNTED", counted)
    rng = random.Random(4)
    texts = [t for size in (9, 30, 31, 40, 90) for _ in range(3) for t in corpus(rng, size, 12, size // 15 + 1)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    check(spark, [(k, t) for k, t in enumerate(texts)], 3, 8, 10)


def test_first_keys_of_linked_sets_meet():
    rng = np.random.default_rng(9)
    pool = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    often = rng.random(len(pool)) < 0.3
    linked = 0
    for size in (1, 2, 5, 30, 400):
        for num, den in ((8, 10), (9, 10), (1, 2), (1, 1)):
            for _ in range(20):
                a = np.sort(rng.choice(pool, size, replace=False))
                b = np.unique(np.concatenate([a[rng.random(size) < 0.95], rng.choice(pool, size // 20)]))
                g, counts = np.concatenate([a, [], b]).astype(np.uint64), np.array([len(a), 0, len(b)])
                keys, n = ngram_join.first_keys(g, counts, often[np.searchsorted(pool, g)], num, den)
                both = len(np.intersect1d(a, b))
                assert n[1] == 0 and len(keys) == n.sum()
                x, y = keys[:n[0]].tolist(), keys[n[0]:].tolist()
                if den * both >= num * (len(a) + len(b) - both) and both:
                    linked += 1
                    i, j = next((x.index(k), y.index(k)) for k in x if k in y)
                    assert (num + den) * min(len(a) - i, len(b) - j) >= num * (len(a) + len(b))
    assert linked > 100
