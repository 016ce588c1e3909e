"""Registered queries against their independent DuckDB SQL (sf0.001).

Training-data queries are compared in ``tests/llm``.
"""

import pytest

import __spark_entry__ as E
from conftest import assert_matches_oracle

SQL = E.oracle_sql()
KEYS = sorted(k for k in SQL if not k.startswith("op"))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = E.queries()[key](spark, sf_dir)
    assert_matches_oracle(df, duck, SQL[key])


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "degree"
    assert df.count() >= 0
