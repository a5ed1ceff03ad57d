"""Known answers for the customer lifetime value model (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fixtures import AS_OF, AS_OF_TS, customer, frames, order, product
from mercato.plans import customers as cust

DAY = dt.timedelta(days=1)


def _clv(spark, customers, orders):
    c, _, o = frames(spark, customers, [product(1)], orders)
    return {r["customer_id"]: r for r in cust.clv(c, o, AS_OF).collect()}


def test_no_orders_and_only_pending(spark):
    rows = _clv(spark, [customer(1), customer(2)],
                [order(10, 2, status="PENDING"), order(11, 2, status="PENDING"),
                 order(12, 2, status="PENDING")])
    for cid in (1, 2):
        r = rows[cid]
        assert r["total_orders"] == 0
        assert float(r["total_revenue"]) == 0.0
        assert r["days_since_last_order"] is None
        assert (r["recency_score"], r["frequency_score"], r["monetary_score"]) == (1, 1, 1)
        assert r["customer_tier"] == "Bronze"
        assert float(r["ltv_score"]) == 0.0


def test_created_on_as_of_day(spark):
    rows = _clv(spark, [customer(1, created=dt.datetime(2024, 6, 30, 8, 0))],
                [order(10, 1, when=dt.datetime(2024, 6, 30, 9, 0))])
    assert rows[1]["days_as_customer"] == 0
    assert rows[1]["ltv_score"] is None


def test_midnight_crossing_counts_calendar_days(spark):
    rows = _clv(spark, [customer(1)], [order(10, 1, when=dt.datetime(2024, 6, 29, 23, 0))])
    assert rows[1]["days_since_last_order"] == 1


def test_recency_edges(spark):
    days = [7, 8, 30, 31, 60, 61, 90, 91]
    expect = [5, 4, 4, 3, 3, 2, 2, 1]
    rows = _clv(spark, [customer(i) for i in range(len(days))],
                [order(100 + i, i, when=AS_OF_TS - d * DAY) for i, d in enumerate(days)])
    assert [rows[i]["recency_score"] for i in range(len(days))] == expect


def test_frequency_edges(spark):
    counts = [1, 2, 3, 4, 5, 9, 10]
    expect = [2, 2, 3, 3, 4, 4, 5]
    orders, oid = [], 1000
    for i, n in enumerate(counts):
        for _ in range(n):
            oid += 1
            orders.append(order(oid, i))
    rows = _clv(spark, [customer(i) for i in range(len(counts))], orders)
    assert [rows[i]["frequency_score"] for i in range(len(counts))] == expect


def test_money_edges(spark):
    amounts = ["0.01", "499.99", "500.00", "1999.99", "2000.00", "4999.99", "5000.00"]
    expect = [2, 2, 3, 3, 4, 4, 5]
    rows = _clv(spark, [customer(i) for i in range(len(amounts))],
                [order(100 + i, i, price=a) for i, a in enumerate(amounts)])
    assert [rows[i]["monetary_score"] for i in range(len(amounts))] == expect


def test_full_discount(spark):
    rows = _clv(spark, [customer(1)], [order(10, 1, disc="100.00")])
    r = rows[1]
    assert float(r["total_revenue"]) == 0.0
    assert (r["frequency_score"], r["monetary_score"]) == (2, 1)


def test_single_order_has_no_gap(spark):
    rows = _clv(spark, [customer(1)], [order(10, 1)])
    assert rows[1]["avg_days_between_orders"] is None


def test_gap_between_orders(spark):
    rows = _clv(spark, [customer(1)],
                [order(10, 1, when=dt.datetime(2024, 6, 1, 23)),
                 order(11, 1, when=dt.datetime(2024, 6, 4, 1)),
                 order(12, 1, when=dt.datetime(2024, 6, 11, 12))])
    # 10 calendar days over 2 gaps
    assert float(rows[1]["avg_days_between_orders"]) == 5.0


def test_half_cent_rounds_up(spark):
    # 1 x 1229652.39 at 50 % off = 614826.195
    rows = _clv(spark, [customer(1)], [order(10, 1, price="1229652.39", disc="50.00")])
    assert str(rows[1]["total_revenue"]) == "614826.20"


def test_two_lines_one_order(spark):
    rows = _clv(spark, [customer(1)], [order(10, 1), order(10, 1, pid=2)])
    assert rows[1]["total_orders"] == 1


def test_unknown_product_still_in_clv(spark):
    rows = _clv(spark, [customer(1)], [order(10, 1, pid=999)])
    assert rows[1]["total_orders"] == 1


def test_tier_edges(spark):
    df = spark.createDataFrame([(s,) for s in (5, 6, 8, 9, 11, 12)], "s int")
    tiers = [r[0] for r in df.select(cust.tier_of(F.col("s"))).collect()]
    assert tiers == ["Bronze", "Silver", "Silver", "Gold", "Gold", "Platinum"]


def test_every_customer_once(spark):
    rows = _clv(spark, [customer(i) for i in range(5)],
                [order(10 + i, i % 3) for i in range(9)])
    assert sorted(rows) == list(range(5))
