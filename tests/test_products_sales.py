"""Hourly metrics and product analysis on hand-built rows."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from fixtures import customer, frames, order, product
from mercato.plans import products as prod
from mercato.plans import sales

T = dt.datetime(2024, 6, 1, 10, 15)


def test_null_discount_counts_in_gross_not_net(spark):
    _, p, o = frames(spark, [customer(1)], [product(1)],
                     [order(10, 1, qty=2, price="10.00", disc=None, when=T),
                      order(11, 1, qty=1, price="10.00", disc="10.00", when=T)])
    r = sales.hourly_sales_metrics(o, p).collect()[0]
    assert float(r["gross_revenue"]) == 30.0
    assert float(r["net_revenue"]) == 9.0
    assert float(r["total_discounts"]) == 1.0


def test_two_lines_of_one_order(spark):
    _, p, o = frames(spark, [customer(1)], [product(1)],
                     [order(10, 1, when=T), order(10, 1, when=T)])
    h = sales.hourly_sales_metrics(o, p).collect()[0]
    assert h["total_orders"] == 1 and h["completed_orders"] == 2
    perf = prod.category_performance(o, p).collect()[0]
    assert perf["order_count"] == 2 and perf["unique_customers"] == 1


def test_unknown_product_dropped(spark):
    _, p, o = frames(spark, [customer(1)], [product(1)],
                     [order(10, 1, pid=1, when=T), order(11, 1, pid=999, when=T)])
    assert sales.hourly_sales_metrics(o, p).agg(F.sum("total_orders")).first()[0] == 1
    assert prod.category_performance(o, p).agg(F.sum("order_count")).first()[0] == 1


def test_hour_bucket_and_status_counts(spark):
    _, p, o = frames(spark, [customer(1)], [product(1)],
                     [order(10, 1, when=dt.datetime(2024, 6, 1, 10, 59, 59), status="PENDING"),
                      order(11, 1, when=dt.datetime(2024, 6, 1, 11, 0, 0), status="SHIPPED")])
    rows = sorted(sales.hourly_sales_metrics(o, p).collect(), key=lambda r: r["sales_hour"])
    assert [r["sales_hour"] for r in rows] == [dt.datetime(2024, 6, 1, 10), dt.datetime(2024, 6, 1, 11)]
    assert (rows[0]["pending_orders"], rows[1]["shipped_orders"]) == (1, 1)


def test_zero_net_revenue_gives_null_margin(spark):
    _, p, o = frames(spark, [customer(1)], [product(1)], [order(10, 1, disc="100.00", when=T)])
    r = prod.product_analysis(prod.category_performance(o, p)).collect()[0]
    assert r["profit_margin_pct"] is None


def test_rank_ties_share_a_rank(spark):
    prods = [product(i) for i in range(1, 13)]
    orders = [order(100 + i, 1, pid=i, price=str(1000 - i) + ".00", when=T) for i in range(1, 13)]
    orders.append(order(200, 1, pid=12, price="11.00", when=T))  # product 12 ties product 1
    _, p, o = frames(spark, [customer(1)], prods, orders)
    top = prod.top_products(o, p, 10).collect()
    ranks = {r["product_id"]: r["rank"] for r in top}
    assert ranks[1] == ranks[12] == 1 and ranks[2] == 2
    assert len(top) == 11


def test_product_analysis_ranks_are_dense_from_one(spark):
    prods = [product(1, "A", "a1"), product(2, "A", "a2"), product(3, "B", "b1")]
    orders = [order(10, 1, pid=1, price="50.00", when=T), order(11, 1, pid=2, price="50.00", when=T),
              order(12, 1, pid=3, price="20.00", when=T)]
    _, p, o = frames(spark, [customer(1)], prods, orders)
    rows = {r["subcategory"]: r for r in prod.product_analysis(prod.category_performance(o, p)).collect()}
    assert rows["a1"]["overall_revenue_rank"] == rows["a2"]["overall_revenue_rank"] == 1
    assert rows["b1"]["overall_revenue_rank"] == 2
    assert rows["b1"]["category_revenue_rank"] == 1


def test_recent_order_details_skips_unknown_customers(spark):
    from fixtures import customer as cust_row
    c, p, o = frames(spark, [cust_row(1)], [product(1)],
                     [order(10, 1, when=dt.datetime(2024, 6, 1, 9)),
                      order(11, 1, when=dt.datetime(2024, 6, 1, 10)),
                      order(12, 99, when=dt.datetime(2024, 6, 1, 11))])  # unknown customer
    rows = sales.recent_order_details(o, c, p, 2).collect()
    assert [r["order_id"] for r in rows] == [11, 10]
    assert rows[0]["customer_name"] == "First1 Last1"


def test_step_durations_count_second_boundaries(spark):
    from mercato.plans import pipeline
    steps = spark.createDataFrame(
        [("a", "x", dt.datetime(2024, 1, 30, 10, 0, 0, 900000), dt.datetime(2024, 1, 30, 10, 0, 1, 100000)),
         ("b", "x", dt.datetime(2024, 1, 29, 23, 0, 0), dt.datetime(2024, 1, 29, 23, 0, 5)),
         ("c", "y", dt.datetime(2024, 1, 30, 23, 59, 59), dt.datetime(2024, 1, 31, 0, 0, 2))],
        "run_id string, name string, started_at timestamp_ntz, completed_at timestamp_ntz")
    rows = pipeline.step_history(steps, "2024-01-31 00:00:00", 24, 20).collect()
    assert [r["run_id"] for r in rows] == ["c", "a"]  # b started before the window
    assert [r["duration_seconds"] for r in rows] == [3, 1]


def test_hourly_tasks_grow_with_the_input(spark, scratch, monkeypatch):
    """the lines of a task grew with the table wherever the count of partitions did not."""
    lines = spark.range(400).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 37).alias("order_id"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("customer_id"), F.lit(1).alias("product_id"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 4).cast("int")).alias("quantity"),
        F.lit(2.5).cast("decimal(12,2)").alias("unit_price"), F.lit(10).cast("decimal(5,2)").alias("discount_pct"),
        F.when(F.col("id") % 3 > 0, F.to_timestamp_ntz(F.lit("2001-07-01 10:20:30"))).alias("order_date"),
        F.lit("SHIPPED").alias("status"), F.when(F.col("id") % 2 > 0, F.lit("a")).alias("category"),
        F.lit("b").alias("subcategory"), F.lit(1).cast("decimal(12,2)").alias("cost_price"))
    lines.repartition(3).write.parquet(f"{scratch}/some lines")
    stored = spark.read.parquet(f"{scratch}/some lines")
    size = sum(p.stat().st_size for p in Path(f"{scratch}/some lines").glob("*.parquet"))
    monkeypatch.setattr(sales, "TASK_BYTES", 100)
    assert sales.input_tasks(stored) == -(-size // 100)
    asked = sales.hourly_of_lines(stored)._jdf.queryExecution().executedPlan().toString()
    assert asked.count(f"{-(-size // 100)}), REPARTITION_BY_NUM") == 2
    # as planned by Spark in one group-by, nulls in keys and groups included
    plain = sales.hourly_metrics_of(lines.withColumn("sales_hour", sales.hour_floor("order_date")), sales.GROUP,
                                    F.countDistinct("order_id"), F.countDistinct("customer_id"))
    rows = lambda df: sorted((tuple(r) for r in df.select(*sales.HOURLY_COLUMNS).collect()), key=str)
    assert rows(sales.hourly_of_lines(stored)) == rows(plain) == rows(sales.hourly_of_lines(lines))
