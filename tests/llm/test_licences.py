import re

import duckdb
import pandas as pd

from censusflow.llm import licences, registry

from conftest import assert_matches_oracle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

TEXTS = [
    (1, "Released under the MIT License."), (2, "(c) Apache License, Version 2.0; apache LICENSE version 2"), (3, "CC BY-NC 4.0 cc by nc cc-by-nc"),
    (4, None), (5, ""), (6, " ,.-"), (7, "under the mit  licensed"), (8, "the mit license under"), (9, "Kelvin under the mİt license"),
    (10, "cc " * 5000 + "by nc"), (11, "x " * 3000 + "All rights reserved under the mit license"), (12, "gnu general public license"),
    (1, "Released under the MIT License."), (None, "cc by nc"), (13, "é cc by nc é"), (14, "the GNU Lesser General Public License"),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, uid string, score string")


def test_places_against_brute_force(spark):
    rows = licences.scan(frame(spark)).collect()
    assert len(rows) == len(TEXTS)
    low = str.maketrans(licences.UPPER, licences.LOWER)
    want = []
    for i, t in TEXTS:
        w = WORD.findall((t or "").translate(low))
        at, labels = [], set()
        for p in licences.PHRASES:
            ws = p.text.split()
            places = [k for k in range(len(w) - len(ws) + 1) if w[k:k + len(ws)] == ws]
            labels |= {p.label} if places else set()
            at += [(k, p.label) for k in places if p.base]
        want.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})), ",".join(sorted(labels))))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:7]) for r in rows)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in rows)


def test_sql_on_fixture(spark):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(TEXTS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    assert_matches_oracle(licences.scan(frame(spark)), con, licences.duckdb_sql())


def test_empty_table(spark):
    assert licences.scan(frame(spark, [])).collect() == []


def test_query_matches_sql(spark, sf_dir, duck):
    assert_matches_oracle(registry.op10_licences(spark, sf_dir), duck, registry.SQL["op10_licences"])


def test_empty_table_long_text_and_clashing_columns(spark):
    from censusflow.llm.licences import scan
    schema = "doc_id long, text string, uid int, word string, phrase string"
    assert scan(spark.createDataFrame([], schema)).collect() == []
    far = "plain " * 300_000 + "CC BY-NC"
    rows = [(1, far, 7, "mit", "x"), (2, None, 7, None, "x"), (2, None, 7, None, "x"), (3, "", 7, "cc", None)]
    got = {(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]): r for r in scan(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {(1, 300_003, 1, 300_000, 300_000, "cc-by-nc"), (2, 0, 0, None, None, ""), (3, 0, 0, None, None, "")}
    assert all(r["labels"] == "" and r["score"] == 0.0 for k, r in got.items() if k[0] != 1)
