"""Incremental refresh equals the full recompute after every micro-batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.functions.money import decimals_to_double
from mercato.plans import pipeline, sales
from mercato.sources import catalog
from mercato.sources.bindings import load_base_tables, orders_dense_from, read_raw
from mercato.streaming import refresh


def _rows(df):
    return sorted(tuple(r) for r in decimals_to_double(df.select(*sales.HOURLY_COLUMNS)).collect())


@pytest.mark.parametrize("unit", ["day", "month"])
def test_incremental_equals_full_per_batch(spark, scratch, unit):
    raw = {n: read_raw(spark, SF_SMALL, n) for n in ("lineitem", "orders", "part")}
    tables = load_base_tables(spark, SF_SMALL)
    products = tables["products"]
    orders = orders_dense_from(raw["lineitem"], raw["orders"], raw["part"])
    # four arrival batches in shuffled time order; the oldest arrives last
    d = F.col("order_date")
    t = lambda s: F.to_timestamp_ntz(F.lit(s))
    batches = [orders.filter(d >= t("2001-07-02 12:00:00")),
               orders.filter((d >= t("2001-07-01 12:00:00")) & (d < t("2001-07-02 12:00:00"))),
               orders.filter(d < t("2001-07-01 06:00:00")),
               orders.filter((d >= t("2001-07-01 06:00:00")) & (d < t("2001-07-01 12:00:00")))]
    handler = refresh.IncrementalHourlyRefresh(products, f"{scratch}/base", f"{scratch}/result",
                                               f"{scratch}/history", unit)
    seen = None
    for batch_id, batch in enumerate(batches):
        handler(batch, batch_id)
        seen = batch if seen is None else seen.unionByName(batch)
        got = _rows(refresh.read_hourly(spark, f"{scratch}/result"))
        assert got == _rows(sales.hourly_sales_metrics(seen, products))
    # a replayed batch (at-least-once delivery) changes nothing
    handler(batches[1], 1)
    assert _rows(refresh.read_hourly(spark, f"{scratch}/result")) == \
        _rows(sales.hourly_sales_metrics(orders, products))
    history = refresh.refresh_history(spark, f"{scratch}/history").collect()
    assert len(history) == 4  # the replay replaced its own history row


def test_full_refresh_is_idempotent(spark, scratch):
    t = load_base_tables(spark, SF_SMALL)
    first = _rows(refresh.refresh_full(t["orders"], t["products"], f"{scratch}/h", "month"))
    second = _rows(refresh.refresh_full(t["orders"], t["products"], f"{scratch}/h", "month"))
    assert first == second == _rows(sales.hourly_sales_metrics(t["orders"], t["products"]))


def test_full_refresh_leaves_readers_their_version(spark, scratch):
    """a refresh removed files that a reader of the version before had still to read."""
    t = load_base_tables(spark, SF_SMALL)
    part = t["orders"].where(F.col("order_id") % 3 == 0)
    before = refresh.refresh_full(part, t["products"], f"{scratch}/h", "month")
    after = refresh.refresh_full(t["orders"], t["products"], f"{scratch}/h", "month")
    assert _rows(before) == _rows(sales.hourly_sales_metrics(part, t["products"]))
    assert _rows(after) == _rows(refresh.read_hourly(spark, f"{scratch}/h"))
    # a full refresh also replaces a table that was kept by differences
    refresh.IncrementalHourlyRefresh(t["products"], f"{scratch}/d", f"{scratch}/d")(part, 0)
    refresh.refresh_full(t["orders"], t["products"], f"{scratch}/d", "month")
    assert _rows(refresh.read_hourly(spark, f"{scratch}/d")) == _rows(after)


def test_run_log_grows_by_two_rows_per_run(spark, scratch):
    t = load_base_tables(spark, SF_SMALL)
    name = "test_run_log"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    pipeline.ensure_run_log(spark, name, f"{scratch}/log")
    run_id = pipeline.run_pipeline(spark, t, "2001-08-02 00:00:00", log_name=name,
                                   hourly_location=f"{scratch}/hourly", unit="month")
    log = spark.table(name).collect()
    assert len(log) == 2
    assert {r["status"] for r in log} == {"STARTED", "COMPLETED"}
    assert {r["run_id"] for r in log} == {run_id}
    assert all(r["created_at"] is not None for r in log)
    steps = pipeline.steps_from_run_log(spark.table(name)).collect()
    assert len(steps) == 1 and steps[0]["completed_at"] >= steps[0]["started_at"]
    assert steps[0]["state"] == "COMPLETED"
    # a failing step shows as FAILED with its whole error; the log keeps growing
    import pytest
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, t | {"products": t["products"].drop("category")},
                              "2001-08-02 00:00:00", log_name=name)
    states = {s["state"]: s["message"] for s in pipeline.steps_from_run_log(spark.table(name)).collect()}
    assert set(states) == {"COMPLETED", "FAILED"} and "category" in states["FAILED"]


def test_staged_lines_and_metrics_are_computed_once(spark, scratch, monkeypatch):
    """range partitions computed the staged lines and the metrics twice, for the bounds and for the rows."""
    t = load_base_tables(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    staged = catalog.stage_orders(t["orders"].mapInArrow(count, t["orders"].schema), f"{scratch}/staged")
    assert seen.value == staged.count() == t["orders"].count()
    hourly = sales.hourly_sales_metrics(t["orders"], t["products"])
    monkeypatch.setattr(refresh, "hourly_sales_metrics", lambda *_: hourly.mapInArrow(count, hourly.schema))
    seen.value = 0
    written = refresh.refresh_full(t["orders"], t["products"], f"{scratch}/h", "month")
    assert seen.value == hourly.count()
    assert _rows(written) == _rows(hourly)
