"""Metrics kept by differences, snapshot differences, refresh on demand, publishing."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.functions.money import decimals_to_double
from mercato.operators import quality
from mercato.operators.bloom import bloom_filter, might_contain
from mercato.plans import sales
from mercato.sources import catalog, sinks
from mercato.streaming import deltas, lag, refresh
from mercato.streaming.history import StreamHistory, refresh_history


def _rows(df):
    return sorted((tuple(r) for r in decimals_to_double(df.select(*sales.HOURLY_COLUMNS)).collect()), key=str)


def _line(order, r, product=None, hour=None):
    at = None if r.random() < 0.1 else dt.datetime(2001, 7, 1 + r.randrange(3), hour if hour is not None else r.randrange(4))
    return (order, r.choice([1, 2, 3, None]), product or r.choice([1, 2, 3, 9]), r.choice([None, 1, 2, 5]),
            r.choice([None, Decimal("10.25"), Decimal("3.10")]), r.choice([None, Decimal("0.00"), Decimal("12.50")]),
            at, r.choice([*sales.STATUSES, None]))


def _products(spark, ids, cost=3):
    return spark.createDataFrame([(i, None if i == 3 else f"c{i % 2}", "s", Decimal(cost + i) if i != 2 else None) for i in ids],
                                 "product_id long, category string, subcategory string, cost_price decimal(12,2)")


def _full(spark, held, products):
    rows = [x for lines in held.values() for x in lines]
    return _rows(sales.hourly_sales_metrics(spark.createDataFrame(rows, refresh.ORDERS_SCHEMA), products))


def test_differences_equal_the_full_recompute(spark, scratch):
    """Late, undated, re-sent, moved, shrunk and removed orders, unknown orders and
    customers, nulls in every measure, new products, replays, merges of runs."""
    r = random.Random(12)
    products = _products(spark, [1, 2, 3])
    handler = refresh.IncrementalHourlyRefresh(products, scratch, f"{scratch}/hourly", f"{scratch}/history", fanout=2)
    held: dict = {}
    for batch_id in range(6):
        orders = r.sample(range(12), 5)
        sent = {o: [_line(o, r) for _ in range(r.randint(1, 4))] for o in orders}
        gone = [o for o in held if o is not None and o not in sent and r.random() < 0.2]
        unnamed = [_line(None, r) for _ in range(2)]
        batch = spark.createDataFrame([x for v in sent.values() for x in v] + unnamed, refresh.ORDERS_SCHEMA)
        handler.apply(batch, batch_id, spark.createDataFrame([(o,) for o in gone], "order_id long") if gone else None)
        for o in gone:
            del held[o]
        held |= sent
        held[None] = held.get(None, []) + unnamed
        assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == _full(spark, held, products)
    handler.apply(batch, batch_id)   # a replay
    handler.apply(batch, 2)
    products = _products(spark, [1, 2, 3, 9], cost=4)
    handler.products_changed(spark, products)
    assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == _full(spark, held, products)
    handler.apply(spark.createDataFrame([], refresh.ORDERS_SCHEMA), 6)
    assert [r.state for r in refresh_history(spark, f"{scratch}/history").collect()] == ["EMPTY"] + ["SUCCEEDED"] * 6
    assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == _full(spark, held, products)


def test_a_failed_batch_leaves_the_state_before(spark, scratch):
    r = random.Random(3)
    first = spark.createDataFrame([_line(1, r, 1), _line(2, r, 1)], refresh.ORDERS_SCHEMA)
    handler = refresh.IncrementalHourlyRefresh(_products(spark, [1]), scratch, f"{scratch}/hourly", f"{scratch}/history")
    handler.apply(first, 0)
    before = _rows(refresh.read_hourly(spark, f"{scratch}/hourly"))
    bad = first.withColumn("quantity", F.expr("CAST(raise_error('no such quantity') AS INT)"))
    with pytest.raises(Exception, match="no such quantity"):
        handler.apply(bad, 1)
    assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == before
    handler.apply(first, 1)
    assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == before
    newest, failed, _ = refresh_history(spark, f"{scratch}/history").collect()
    assert (newest.state, failed.state) == ("SUCCEEDED", "FAILED") and "no such quantity" in failed.message


def test_files_read_by_a_batch_do_not_grow(spark, scratch):
    handler = refresh.IncrementalHourlyRefresh(_products(spark, [1, 2]), scratch, f"{scratch}/hourly", fanout=3)
    r = random.Random(5)
    read = []
    for batch_id in range(16):
        lines = [_line(100 * batch_id + k, r, 1 + k % 2, hour=batch_id % 4) for k in range(4)]
        if batch_id:
            lines.append(_line(100 * r.randrange(batch_id), r, 1))  # an old order again
        handler.apply(spark.createDataFrame(lines, refresh.ORDERS_SCHEMA).coalesce(1), batch_id)
        read.append(handler.files_read)
    assert max(read[10:]) <= max(read[4:10]) + 2, read  # levels, not batches
    manifest = deltas.Manifest(spark, f"{scratch}/hourly")
    assert all(len(runs) <= 6 for runs in manifest.load()["tables"].values())
    assert len(manifest.numbers()) <= deltas.KEEP_MANIFESTS + 3  # old ones go


def test_bloom_filter_keeps_every_member(spark):
    members = spark.range(0, 3000, 3).toDF("k")
    bloom = bloom_filter(members, ["k"], blocks=512)
    kept = {r.k for r in might_contain(spark.range(3000).toDF("k"), bloom, ["k"], blocks=512).collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 2000
    assert bloom.count() <= 512


def test_snapshot_difference_feeds_the_refresh(spark, scratch):
    r = random.Random(9)
    old = {o: [_line(o, r, 1) for _ in range(2)] for o in range(20)}
    new = {o: v for o, v in old.items() if o not in (3, 4)} | {30: [_line(30, r, 1)], 5: old[5][:1], 6: old[6] + old[6][:1]}
    frame = lambda d: spark.createDataFrame([x for v in d.values() for x in v], refresh.ORDERS_SCHEMA)
    diff = catalog.diff_snapshots(frame(old), frame(new), "order_id", buckets=8)
    assert {tuple(x) for x in diff.collect()} == {(3, "deleted"), (4, "deleted"), (30, "inserted"), (5, "changed"), (6, "changed")}
    handler = refresh.IncrementalHourlyRefresh(_products(spark, [1]), scratch, f"{scratch}/hourly")
    handler.apply(frame(old), 0)
    handler.apply(frame(new).join(diff, "order_id", "left_semi"), 1, diff.where("change = 'deleted'"))
    assert _rows(refresh.read_hourly(spark, f"{scratch}/hourly")) == _full(spark, new, _products(spark, [1]))


def test_snapshot_difference_sees_nulls_and_repeats(spark):
    old = spark.createDataFrame([(None, "a"), (1, None), (2, "x"), (2, "x"), (3, "same")], "k int, v string")
    new = spark.createDataFrame([("a", None), ("", 1), ("x", 2), ("same", 3)], "v string, k int")
    assert {tuple(x) for x in catalog.diff_snapshots(old, new, "k").collect()} == {(1, "changed"), (2, "changed")}
    assert catalog.diff_snapshots(old, old, "k").collect() == []


def test_refresh_on_demand(spark, scratch):
    r = random.Random(1)
    orders, products, result = f"{scratch}/orders", f"{scratch}/products", f"{scratch}/hourly"
    write = lambda rows: spark.createDataFrame(rows, refresh.ORDERS_SCHEMA).coalesce(1).write.mode("append").parquet(orders)
    held = {1: [_line(1, r, 1)], 2: [_line(2, r, 2)]}
    write([x for v in held.values() for x in v])
    _products(spark, [1, 2]).write.parquet(products)
    due = lag.LagDrivenRefresh(orders, products, result, target_lag=dt.timedelta(hours=1))

    def look():
        row = due.refresh_when_due(spark).first()
        assert _rows(refresh.read_hourly(spark, result)) == _full(spark, held, spark.read.parquet(products))
        assert row.within_target and row.lag_seconds >= 0 and row.target_lag_seconds == 3600
        return row.decision

    assert look() == "FULL"
    before = deltas.Manifest(spark, result).numbers()
    assert look() == "NO_CHANGE" and deltas.Manifest(spark, result).numbers() == before
    held[3] = [_line(3, r, 1)]
    write(held[3])
    assert look() == "INCREMENTAL"
    _products(spark, [1, 2], cost=8).write.mode("overwrite").parquet(products)
    assert look() == "INCREMENTAL"
    del held[1], held[2]
    spark.createDataFrame(held[3], refresh.ORDERS_SCHEMA).write.mode("overwrite").parquet(orders)
    assert look() == "FULL"


def test_a_failing_build_keeps_the_old_table(spark, scratch):
    checks = lambda df: quality.quality_report(df, unique=["k"], not_null=["k"])
    place = f"{scratch}/t"
    spark.sql("DROP TABLE IF EXISTS tested_table")
    for k in range(4):
        sinks.publish_table(spark.range(3 + k).toDF("k"), "tested_table", checks, place, keep=2)
    with pytest.raises(sinks.FailedChecks, match="unique"):
        sinks.publish_table(spark.createDataFrame([(1,), (1,)], "k long"), "tested_table", checks, place)
    assert spark.table("tested_table").count() == 6
    assert len(sinks.table_versions(spark, "tested_table", place)) == 2
    sinks.publish_table(spark.range(2).withColumn("more", F.lit("x")).withColumnRenamed("id", "k"), "tested_table", checks, place)
    assert spark.table("tested_table").columns == ["k", "more"]


def test_stream_history_records_failures(spark, scratch):
    r = random.Random(2)
    heard = StreamHistory()
    spark.streams.addListener(heard)
    try:
        spark.createDataFrame([_line(1, r, 1)], refresh.ORDERS_SCHEMA).write.parquet(f"{scratch}/in")

        def run(handler, name):
            q = (refresh.order_stream(spark, f"{scratch}/in", None).writeStream.queryName(name).foreachBatch(handler)
                 .option("checkpointLocation", f"{scratch}/{name}").trigger(availableNow=True).start())
            try:
                q.awaitTermination()
            except Exception:  # noqa: BLE001 the stream's own error
                pass
            assert heard.finished(q)

        def fail(batch, batch_id):
            raise ValueError("bad batch")

        run(lambda b, i: b.count(), "good")
        run(fail, "bad")
        heard.save(spark, f"{scratch}/log")
        log = {(x.query, x.state): x for x in spark.read.parquet(f"{scratch}/log").collect()}
        assert log["good", "SUCCEEDED"].input_rows == 1 and log["good", "SUCCEEDED"].duration_ms >= 0
        assert "bad batch" in log["bad", "FAILED"].message
    finally:
        spark.streams.removeListener(heard)


def test_what_a_grouping_made_is_written_without_a_second_pass(spark, scratch):
    """keys and sums were computed twice, once for the bounds of their ranges."""
    store = deltas.DeltaStore(spark, scratch, "order_id long, batch_id long")
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda k: seen.add(1) or k, "long").asNondeterministic()
    rows = spark.range(100).select(counted("id").alias("key"), *[F.lit("x").alias(c) for c in (*deltas.GROUP, "kind")])
    for n, (name, order) in enumerate({"keys": ["sales_hour", "kind", "key"], "sums": deltas.GROUP}.items(), 1):
        run = store.write(name, rows, order, 0, 0)
        assert seen.value == 100 * n
        assert spark.read.parquet(f"{scratch}/{run['name']}").count() == 100


def test_keys_without_stored_counts_are_not_grouped_again(spark):
    """F8: every key of a batch was shuffled once more to meet the stored counts, also where there were none."""
    hour = dt.datetime(2001, 7, 1, 5)
    schema = deltas._KEYS_SCHEMA
    changes = spark.createDataFrame([(hour, None, "s", "order", 1, 2), (hour, "a", "s", "order", 2, -1),
                                     (None, "a", "s", "customer", 3, 1), (hour, "a", "s", "customer", 4, 1)], schema)
    before = spark.createDataFrame([(hour, None, "s", "order", 1, 1), (hour, "a", "s", "order", 2, 3),
                                    (hour, "a", "s", "order", 2, -2), (hour, "b", "s", "order", 9, 1)], schema)

    def counts(held):
        return {(r.sales_hour, r.category): (r.total_orders, r.unique_customers)
                for r in deltas.distinct_changes(changes, held).collect()}

    assert counts(before) == {(hour, "a"): (-1, 1), (None, "a"): (0, 1)}
    assert counts(None) == {(hour, None): (1, 0), (None, "a"): (0, 1), (hour, "a"): (0, 1)}
    plan = deltas.distinct_changes(changes, None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
