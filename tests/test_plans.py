"""Physical-plan checks: the plans we want, not just the right rows."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from mercato.plans import customers as cust
from mercato.plans import products as prod
from mercato.sources import catalog
from mercato.sources.bindings import TEST_AS_OF, load_base_tables

CHEAP = sorted(set(entry.oracle_sql()) - {
    "hourly_refresh_full", "hourly_refresh_incremental", "save_clv", "save_product_analysis",
    "product_analysis_top10", "external_table_scan"})


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", CHEAP)
def test_no_cartesian_or_nested_loop_join(spark, name):
    text = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_clv_aggregates_orders_before_the_outer_join(spark):
    t = load_base_tables(spark, SF_SMALL)
    lines = plan_of(cust.clv(t["customers"], t["orders"], TEST_AS_OF)).splitlines()
    join_at = next(i for i, line in enumerate(lines) if "LeftOuter" in line)
    assert any("HashAggregate(keys=[customer_id" in line for line in lines[join_at:])
    assert not any("HashAggregate(keys=[customer_id" in line for line in lines[:join_at])


def test_top_products_limits_before_the_global_window(spark):
    t = load_base_tables(spark, SF_SMALL)
    text = plan_of(prod.top_products(t["orders"], t["products"], 10))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hourly_is_one_pass_with_expand(spark):
    text = plan_of(entry.queries()["hourly_sales_metrics"](spark, SF_SMALL))
    assert "Expand" in text


def test_status_filter_reaches_staged_scan(spark, scratch):
    t = load_base_tables(spark, SF_SMALL)
    staged = catalog.stage_orders(t["orders"], f"{scratch}/orders").drop("order_month")
    text = plan_of(prod.category_performance(staged, t["products"]))
    assert "PushedFilters: [IsNotNull(status), In(status" in text or \
        "In(status, [COMPLETED,SHIPPED])" in text
