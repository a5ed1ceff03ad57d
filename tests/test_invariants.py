"""Invariants on the bound test tables."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.functions.money import sum_gross, sum_net
from mercato.plans import customers as cust
from mercato.plans import products as prod
from mercato.plans import sales
from mercato.sources.bindings import TEST_AS_OF, load_base_tables


@pytest.fixture(scope="module")
def tables(spark):
    return load_base_tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def hourly(tables):
    return sales.hourly_sales_metrics(tables["orders"], tables["products"]).cache()


def test_gross_net_discount(hourly):
    bad = hourly.filter((F.col("gross_revenue") < F.col("net_revenue"))
                        | (F.col("net_revenue") + F.col("total_discounts")
                           != F.col("gross_revenue"))).count()
    assert bad == 0


def test_hourly_rolls_up_to_global(tables, hourly):
    lines = tables["orders"].join(tables["products"], "product_id")
    total = lines.agg(sum_gross().alias("g"), sum_net().alias("n"),
                      F.sum("quantity").alias("q"), F.count(F.lit(1)).alias("rows")).first()
    rolled = hourly.agg(F.sum("gross_revenue").alias("g"), F.sum("net_revenue").alias("n"),
                        F.sum("units_sold").alias("q"),
                        F.sum(F.col("completed_orders") + F.col("pending_orders")
                              + F.col("processing_orders") + F.col("shipped_orders"))
                        .alias("rows")).first()
    assert (total["g"], total["n"], total["q"], total["rows"]) == \
        (rolled["g"], rolled["n"], rolled["q"], rolled["rows"])


def test_every_customer_exactly_once(tables):
    clv = cust.clv(tables["customers"], tables["orders"], TEST_AS_OF)
    assert clv.count() == tables["customers"].count() == clv.select("customer_id").distinct().count()


def test_ranks_dense_from_one(tables):
    pa = prod.product_analysis(prod.category_performance(tables["orders"], tables["products"]))
    overall = sorted({r[0] for r in pa.select("overall_revenue_rank").collect()})
    assert overall == list(range(1, len(overall) + 1))
    for cat in pa.select("category").distinct().collect():
        ranks = sorted({r[0] for r in pa.filter(F.col("category") == cat[0])
                        .select("category_revenue_rank").collect()})
        assert ranks == list(range(1, len(ranks) + 1))


def test_quintile_sizes_differ_by_at_most_one(tables):
    rfm = cust.rfm_ntile(tables["orders"], TEST_AS_OF).collect()
    for col in ("r_score", "f_score", "m_score"):
        sizes = Counter(r[col] for r in rfm).values()
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
