"""Shared fixtures: one local Spark session, DuckDB views over the smallest test tables."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("CENSUSFLOW_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from censusflow.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="censusflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def assert_matches_oracle(df, con, sql):
    rows = df.collect()
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    a, b = canon(df.columns, rows), canon(ocols, res.fetchall())
    assert a[0] == b[0], f"columns differ: {a[0]} vs {b[0]}"
    assert len(a[1]) == len(b[1]), f"row counts differ: {len(a[1])} vs {len(b[1])}"
    assert a[1] == b[1]
