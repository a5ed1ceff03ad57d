"""Every registered query against its DuckDB oracle on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

QUERIES = entry._queries()  # the training-data operators have tests of their own
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_refresh_history_accounts_for_every_line(spark):
    history = QUERIES["refresh_history"](spark, SF_SMALL)
    rows = history.collect()
    assert {r.state for r in rows} == {"SUCCEEDED"}
    # every line once, and those of the orders that are sent again once more
    orders = QUERIES["scan_orders"](spark, SF_SMALL)
    again = orders.where(orders.order_id % entry.RESENT_EVERY == 0).count()
    assert again and sum(r.input_rows for r in rows) == orders.count() + again


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "overall_revenue_rank" in df.columns
