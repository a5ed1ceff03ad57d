"""Scalable NTILE equals SQL NTILE; data-quality checks on broken data."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.operators.ntile import ntile, ntile_window


def _buckets(spark, n_rows, n, partitions=4, keys=None):
    keys = keys or [(i, (i * 7919) % 13) for i in range(n_rows)]
    df = spark.createDataFrame(keys, "id long, k long")
    order = [F.col("k").desc_nulls_last(), F.col("id")]
    a = {r["id"]: r["b"] for r in ntile(df, n, order, "b", partitions).collect()}
    b = {r["id"]: r["b"] for r in ntile_window(df, n, order, "b").collect()}
    return a, b


def test_ntile_sizes_12_into_5(spark):
    a, b = _buckets(spark, 12, 5)
    assert a == b
    assert [Counter(a.values())[i] for i in range(1, 6)] == [3, 3, 2, 2, 2]


def test_ntile_fewer_rows_than_buckets(spark):
    a, b = _buckets(spark, 3, 5)
    assert a == b and sorted(a.values()) == [1, 2, 3]


@pytest.mark.parametrize("n_rows,n,parts", [(1, 5, 3), (39, 7, 5), (150, 5, 8), (1000, 3, 16)])
def test_ntile_matches_window(spark, n_rows, n, parts):
    a, b = _buckets(spark, n_rows, n, parts)
    assert a == b
    sizes = Counter(a.values()).values()
    assert max(sizes) - min(sizes) <= 1


def test_ntile_hot_key(spark):
    # a third of all rows share one sort key: the tie-break still splits them
    keys = [(i, 0 if i % 3 == 0 else i) for i in range(300)]
    a, b = _buckets(spark, 300, 5, 8, keys)
    assert a == b


def _clv_like(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, total_orders long, customer_tier string")


def test_quality_good_data(spark):
    df = _clv_like(spark, [(1, 1, "Gold"), (2, 0, "Bronze")])
    report = {(r["check_name"], r["column_name"]): r["failures"]
              for r in quality.quality_report(df, ["customer_id"], ["customer_id", "total_orders"],
                                              {"customer_tier": ["Platinum", "Gold", "Silver",
                                                                 "Bronze"]}).collect()}
    assert set(report.values()) == {0}


def test_quality_broken_rows_each_reported_once(spark):
    df = _clv_like(spark, [(1, 1, "Gold"), (1, 2, "Gold"), (None, 1, "Silver"),
                           (3, 1, "Diamond")])
    tiers = ["Platinum", "Gold", "Silver", "Bronze"]
    assert quality.unique_check(df, "customer_id").first()["failures"] == 1
    assert quality.not_null_check(df, "customer_id").first()["failures"] == 1
    assert quality.accepted_values_check(df, "customer_tier", tiers).first()["failures"] == 1
    report = quality.quality_report(df, ["customer_id"], ["customer_id"], {"customer_tier": tiers})
    assert {r["status"] for r in report.collect()} == {"FAIL"}
