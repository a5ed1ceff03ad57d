"""SQL over the registered base views agrees with the DataFrame plans."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from mercato.functions.money import decimals_to_double
from mercato.plans import customers as cust
from mercato.plans import sales
from mercato.sources.bindings import TEST_AS_OF, load_base_tables


@pytest.fixture(scope="module")
def tables(spark):
    return load_base_tables(spark, SF_SMALL, register_views=True)


def test_statuses_add_up_over_all_hours(spark, tables):
    by_status = dict(spark.sql("SELECT lower(status) || '_orders', count(*) FROM orders GROUP BY 1").collect())
    hourly = sales.hourly_sales_metrics(tables["orders"], tables["products"])
    totals = hourly.groupBy().sum(*[f"{s.lower()}_orders" for s in sales.STATUSES]).first().asDict()
    assert {k[4:-1]: v for k, v in totals.items() if v} == by_status


def test_units_and_gross_add_up_over_all_hours(spark, tables):
    units, gross = spark.sql("SELECT sum(quantity), sum(quantity * unit_price) FROM orders").first()
    hourly = sales.hourly_sales_metrics(tables["orders"], tables["products"])
    got = hourly.groupBy().agg({"units_sold": "sum", "gross_revenue": "sum"}).first()
    assert got["sum(units_sold)"] == units and got["sum(gross_revenue)"] == gross


def test_every_customer_has_one_value_row(spark, tables):
    clv = cust.clv(tables["customers"], tables["orders"], TEST_AS_OF)
    n, = spark.sql("SELECT count(*) FROM customers").first()
    assert clv.count() == n == clv.select("customer_id").distinct().count()
    units, = spark.sql("SELECT sum(quantity) FROM orders WHERE status IN ('COMPLETED', 'SHIPPED')").first()
    assert decimals_to_double(clv).groupBy().sum("total_units").first()[0] == units
