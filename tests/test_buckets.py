"""NTILE by boundary selection equals SQL NTILE."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.operators.buckets import bucket_starts, ntiles
from mercato.operators.ntile import ntile_window
from mercato.plans import customers as cust
from mercato.sources.bindings import TEST_AS_OF, load_base_tables


def test_starts_of_buckets():
    assert bucket_starts(12, 5) == [3, 6, 8, 10]
    assert bucket_starts(3, 5) == [1, 2]
    assert bucket_starts(0, 5) == []


@pytest.mark.parametrize("rows,n,cell_rows", [(0, 5, 10), (1, 5, 10), (3, 5, 1), (500, 7, 5), (2000, 5, 1_000_000), (2000, 5, 3)])
def test_equals_the_window(spark, rows, n, cell_rows):
    """Distinct values, a value of a third of all rows, nulls, few rows to a cell."""
    r = random.Random(rows)
    table = [(i, r.choice([0, 0, r.randrange(20), None]), Decimal(r.randrange(10 ** 6)) / 100, 7) for i in range(rows)]
    r.shuffle(table)
    df = spark.createDataFrame(table, "id long, ties int, spread decimal(20,2), same int").repartition(5)
    got = ntiles(df, n, {"a": -F.col("ties"), "b": F.col("spread"), "c": F.col("same")}, F.col("id"), cell_rows)
    want = df
    for key, name in ((F.col("ties").desc_nulls_last(), "a"), (F.col("spread").asc_nulls_last(), "b"), (F.col("same"), "c")):
        want = ntile_window(want, n, [key, F.col("id")], name)
    columns = ["id", "a", "b", "c"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_rfm_scores_equal_the_window_form(spark):
    orders = load_base_tables(spark, SF_SMALL)["orders"]
    orders = orders.withColumn("customer_id", F.when(F.col("customer_id") % 50 != 0, F.col("customer_id")))
    got, want = (sorted(map(str, cust.rfm_ntile(orders, TEST_AS_OF, scalable=x).collect())) for x in (True, False))
    assert got == want


def test_no_shuffle_after_the_boundaries_are_known(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("k"))
    plan = ntiles(df, 5, {"s": F.col("k")}, F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
