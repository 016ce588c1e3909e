import math
import random
import re

from censusflow.llm import registry
from censusflow.llm.lexical import search

from conftest import assert_matches_oracle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in wanted.items():
        found = []
        for i, b in bags:
            if i is None or not b:
                continue
            m = 100 - 50 + (50 * len(b) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b.count(t)) // (1000 * b.count(t) + 20 * m)) for t in words if t in b)
            if s > 0:
                found.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, docs, items, k=3, **kw):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, task int").repartition(3)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    return sorted(tuple(r) for r in search(d, q, k=k, **kw).collect())


def test_random_ties_repeats_nulls(spark):
    rng = random.Random(11)
    voc = ["Ab", "b", "Ç", "Éa", "x9", "The", "zz", "naïve", "日本", "q"]
    text = lambda n: rng.choice([" ", "-", "\n", "_"]).join(rng.choice(voc) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 12))) for i in range(120)]
    docs += [(i, "hot hot word") for i in range(200, 240)] + [(7, docs[7][1]), (7, docs[7][1]), (8, "other text q"), (None, "Ab b zz"), (300, None), (301, ""), (302, " ..."), (303, "zz " * 3000)]
    items = [(1, "ab B the"), (2, "hot word Ç"), (2, "naïve"), (2, "naïve"), (3, "unknown"), (4, None), (5, ""), (None, "ab"), (6, " ".join(voc))]
    assert run(spark, docs, items) == brute(docs, items, 3)
    assert run(spark, docs, items, k=500) == brute(docs, items, 500)
    assert run(spark, docs, items, item_tile=1) == brute(docs, items, 3)


def test_small_tiles(spark, monkeypatch):
    from censusflow.llm import lexical
    monkeypatch.setattr(lexical, "_DENSE", 0)
    monkeypatch.setattr(lexical, "_PENDING", 5)
    monkeypatch.setattr(lexical, "TERM_TILE", 3)
    monkeypatch.setattr(lexical, "DOC_TILE", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(7)]
    assert run(spark, docs, items, k=5) == brute(docs, items, 5)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_query_matches_sql(spark, sf_dir, duck):
    assert_matches_oracle(registry.op11_lexical_search(spark, sf_dir), duck, registry.SQL["op11_lexical_search"])
