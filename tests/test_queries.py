"""Every named query against DuckDB on the same small tables."""

import os
import subprocess
import sys

import compare
import pytest
from __spark_entry__ import entry, oracle_sql, queries

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return compare.database(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf, con, name):
    assert compare.mismatch(queries()[name](spark, sf), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name,keys", [
    ("sort_one_column", [("window_start", 1)]), ("sort_two_columns", [("symbol", 1), ("window_start", 1)]),
    ("windows_per_symbol", [("windows", -1), ("symbol", 1)]), ("anomaly_rate_by_symbol", [("anomaly_pct", -1), ("symbol", 1)]),
    ("price_band", [("symbol", 1), ("window_start", 1)]), ("distinct_symbols", [("symbol", 1)])])
def test_rows_come_in_order(spark, sf, name, keys):
    rows = [r.asDict() for r in queries()[name](spark, sf).collect()]
    want = rows
    for key, way in reversed(keys):
        want = sorted(want, key=lambda r: r[key], reverse=way < 0)
    names = [key for key, _ in keys]
    assert rows and [[r[k] for k in names] for r in rows] == [[r[k] for k in names] for r in want]


def test_entry_without_a_library_of_the_document_operators():
    code = ("import sys; sys.modules['xxhash'] = None; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; "
            "names = set(e.queries()); assert 'window_features' in names and not any(n.startswith('op') or n == 'pipeline' for n in names)")
    subprocess.run([sys.executable, "-c", code, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))], check=True, timeout=120)
