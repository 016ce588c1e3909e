import hashlib
import random
import re
from collections import defaultdict

from censusflow.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(s):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or ""))


def brute(docs, items, window=13):
    found = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            found[tuple(w[k:k + n])].add(i)
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(g) for g in found}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in found:
                    hit.update(range(k, k + n))
                    ids |= found[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(repr, out))


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, h int, ctx string").repartition(3)
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, at string")
    rows = decontaminate(d, b).drop("text_key").collect()
    assert sorted(repr(tuple(r)) for r in rows) == brute(docs, items)


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(6)] + ["É", "日本", "A1"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 40]))) for i in range(100, 125)]
    items += [(200, None), (201, ""), (202, ".,"), (None, text(13)), (203, items[0][1]), (100, items[1][1]), (204, "same " * 30)]
    docs = []
    for i in range(60):
        t = text(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1) if w else 0
            t += " " + " ".join(w[a:a + rng.choice([5, 12, 13, 14, 30])]).upper() + " " + text(rng.randrange(3))
        docs.append((i, t))
    docs += [(300, None), (301, ""), (None, items[3][1]), docs[5], docs[5], (5, text(20)), (302, "same " * 500), (303, text(20_000))]
    check(spark, docs, items)


def test_only_long_items_and_empty_tables(spark):
    rng = random.Random(1)
    long = " ".join(f"t{rng.randrange(50)}" for _ in range(200))
    docs = [(1, "start " + long + " end"), (2, " ".join(long.split()[50:62])), (3, " ".join(long.split()[50:63]))]
    check(spark, docs, [(1, long)])
    check(spark, docs, [])
    check(spark, [], [(1, long)])
