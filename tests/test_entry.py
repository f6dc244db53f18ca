"""The driver contract at sf0.001: entry runs, and every query matches its DuckDB oracle."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    got = df.collect()
    assert df.columns == ["factor", "category", "prop"] and len(got) == 15


def test_keys_line_up():  # noqa: D103
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # the others are tested in tests/llm
    assert own - set(o) == {"output_sizes"}


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import digest

    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(ocols, want)
