"""The routed, windowed stream: exact, complete and bounded by its delay."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from mercato.functions.money import decimals_to_double
from mercato.plans import sales
from mercato.session import checkpoint_root
from mercato.sources import files
from mercato.sources.bindings import load_base_tables, orders_dense_from, read_raw
from mercato.streaming import refresh, windowed
from mercato.streaming.history import StreamHistory


def _rows(df):
    return sorted((tuple(r) for r in decimals_to_double(df.select(*sales.HOURLY_COLUMNS)).collect()), key=str)


def test_late_undated_and_dense_lines(spark, scratch):
    """Many lines per hour; hours close while the feed goes on; late and undated lines are repaired."""
    raw = {n: read_raw(spark, SF_SMALL, n) for n in ("lineitem", "orders", "part")}
    products = load_base_tables(spark, SF_SMALL)["products"]
    orders = orders_dense_from(raw["lineitem"], raw["orders"], raw["part"])
    orders = orders.withColumn("order_date", F.when(F.col("order_id") % 31 != 0, F.col("order_date"))).persist()
    start = dt.datetime(2001, 7, 1)
    quarter = F.floor(F.timestamp_diff("HOUR", F.lit(start).cast("timestamp_ntz"), F.col("order_date")) / 12)
    part = F.coalesce(quarter, F.lit(1)) + (F.col("order_id") % 17 == 0).cast("int")
    versions = f"{scratch}/versions"
    entry._first_versions(products).write.parquet(versions)
    router = windowed.ArrivalRouter(versions, f"{scratch}/routed", 2)
    heard = StreamHistory()
    spark.streams.addListener(heard)
    emitted = []

    def drain():
        q = (windowed.exact_hourly_stream(windowed.line_stream(spark, router.on_time), "2 hours").writeStream
             .outputMode("append").format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        assert heard.finished(q)
        emitted.append(spark.read.schema(q_schema).parquet(f"{scratch}/out").count())

    q_schema = sales.hourly_sales_metrics(orders, products).schema
    try:
        for k in range(5):
            router(orders.where(part == k), k)
            router(orders.where(part == k), k)  # a replay
            drain()
        windowed.close_hours(spark, router.on_time, dt.datetime(2001, 7, 3) + dt.timedelta(hours=4))
        drain()
    finally:
        spark.streams.removeListener(heard)
    assert heard.dropped() == 0
    assert emitted[1] > 0 and emitted == sorted(emitted) and len(set(emitted)) >= 4  # hours close on the way
    late = windowed.read_lines(spark, router.late)
    assert late.where("sales_hour IS NULL").count() > 0 and late.where("sales_hour IS NOT NULL").count() > 0
    on_time = windowed.read_lines(spark, router.on_time).where("order_id IS NOT NULL")
    got = windowed.repaired(spark.read.parquet(f"{scratch}/out"), on_time, late)
    assert _rows(got) == _rows(sales.hourly_sales_metrics(orders, products))


def test_versions_valid_at_the_lines_time(spark):
    t = lambda d: None if d is None else dt.datetime(2001, 7, d)
    versions = spark.createDataFrame(
        [(1, "a", "s", Decimal(1), t(None), t(3)), (1, "b", "s", Decimal(2), t(3), t(None)), (2, "c", "s", Decimal(5), t(4), t(5))],
        "product_id long, category string, subcategory string, cost_price decimal(12,2), valid_from timestamp_ntz, valid_to timestamp_ntz")
    lines = [(k, 1, p, 1, Decimal("1"), Decimal("0"), t(d), "PENDING") for k, (p, d) in
             enumerate([(1, 1), (1, 3), (1, None), (2, 3), (2, 4), (2, 5), (7, 1)])]
    got = windowed.as_of_join(spark.createDataFrame(lines, refresh.ORDERS_SCHEMA), versions)
    assert {(r.order_id, r.category) for r in got.collect()} == {(0, "a"), (1, "b"), (2, "b"), (4, "c")}


@pytest.mark.parametrize("name", ["hourly_stream_windowed"])
def test_stream_does_not_depend_on_its_delay(spark, monkeypatch, name):
    t = load_base_tables(spark, SF_SMALL)
    monkeypatch.setattr(entry, "DELAY_HOURS", 48)
    assert _rows(entry._queries()[name](spark, SF_SMALL)) == _rows(sales.hourly_sales_metrics(t["orders"], t["products"]))


def test_repair_asks_the_bloom_filter_first(spark):
    """lines and results of hours without late lines are not shuffled for exact joins; nulls in a
    group are equal."""
    hour = dt.datetime(2001, 7, 1, 5)

    def line(order, category, at=hour):
        return (order, 1, 2, Decimal("3.00"), Decimal("0.00"), "PENDING", at, category, None, Decimal("1.00"))

    on_time = spark.createDataFrame([line(1, "a"), line(2, None), line(3, None), line(4, "b")], windowed._LINE)
    late = spark.createDataFrame([line(2, None), line(5, None), line(6, "a", None)], windowed._LINE)
    count = [F.countDistinct("order_id"), F.countDistinct("customer_id")]
    hourly = sales.hourly_metrics_of(on_time, sales.GROUP, *count).select(*sales.HOURLY_COLUMNS)
    got = windowed.repaired(hourly, on_time, late)
    assert _rows(got) == _rows(sales.hourly_metrics_of(on_time.unionByName(late), sales.GROUP, *count))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_bloom" in plan and "LeftSemi" not in plan and "LeftAnti" not in plan


def test_arriving_lines_are_computed_once(spark, scratch):
    """F7, F8, F9: range partitions computed the lines twice, for the bounds and for the rows."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    orders = load_base_tables(spark, SF_SMALL)["orders"]
    entry._arrive(orders.mapInArrow(count, orders.schema), scratch)
    assert seen.value == orders.count() == spark.read.parquet(scratch).count()


def test_stream_keeps_no_keys_of_a_batch_in_memory(spark):
    """all keys of a batch lay in the state stores, in the executors' memory."""
    root = checkpoint_root(spark)
    before = set(files.names(spark, root))
    t = load_base_tables(spark, SF_SMALL)
    assert _rows(entry.q_hourly_stream_windowed(spark, SF_SMALL)) == _rows(sales.hourly_sales_metrics(t["orders"], t["products"]))
    new = [n for n in files.names(spark, root) if n not in before and n.startswith("stream_checkpoint")]
    assert len(new) == 2 and not [n for n in new if files.exists(spark, f"{root}/{n}/state")]


def test_closer_keeps_the_lines_of_open_hours(spark, scratch):
    """keys that come again in a later batch count once; a replay does nothing; nothing is dropped."""
    def lines(*rows):
        return spark.createDataFrame(
            [(o, c, 1, Decimal("3.00"), Decimal("0.00"), "PENDING", None if h is None else dt.datetime(2001, 7, 1, h), "a", None,
              Decimal("1.00")) for o, c, h in rows], windowed._LINE)

    closer = windowed.HourCloser(scratch, 2)
    batches = [lines((1, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 4)), lines((2, 1, 3), (3, 1, 4), (4, 1, 4)), lines((5, None, 9)),
               lines((6, 2, 12)).where("order_id < 0")]
    closed, kept = [], []
    for k, b in enumerate(batches):
        for _ in range(2):
            closer(b, k)
        closed.append(sorted(r.sales_hour.hour for r in closer.closed_hours(spark).collect()))
        kept.append(sorted(r.sales_hour.hour for r in windowed.read_lines(spark, f"{scratch}/open/batch={k:012d}").collect()))
    assert closed == [[1, 2], [1, 2], [1, 2, 3, 4], [1, 2, 3, 4]]
    assert kept == [[4], [3, 4, 4, 4], [9], [9]]
    assert files.names(spark, f"{scratch}/open") == ["batch=000000000003"]
    every = batches[0].unionByName(batches[1])
    count = [F.countDistinct("order_id"), F.countDistinct("customer_id")]
    assert _rows(closer.closed_hours(spark)) == _rows(sales.hourly_metrics_of(every, sales.GROUP, *count))
    for bad in (7, None):
        with pytest.raises(RuntimeError):
            closer(lines((7, 1, bad)), 4)


def test_lines_are_grouped_in_one_pass(spark, monkeypatch):
    """each line was computed and shuffled three times, for the sums and for each key.  Nulls in groups, keys and
    measures; tasks with more rows than they may hold."""
    hour = dt.datetime(2001, 7, 1, 5)
    rows = [(None if k % 7 == 0 else k % 50, None if k % 5 == 0 else k % 9, None if k % 11 == 0 else k % 4 - 1, Decimal("3.00"),
             Decimal("1.50"), ["PENDING", "SHIPPED", "DRAFT", None][k % 4], hour + dt.timedelta(hours=k % 3),
             None if k % 13 == 0 else "c%d" % (k % 2), None if k % 2 else "s", Decimal("1.00")) for k in range(400)]
    rows += [(1, None, None, None, None, None, hour, "empty", "x", None)]
    lines = spark.createDataFrame(rows, windowed._LINE)
    want = sales.hourly_metrics_of(lines, sales.GROUP, F.countDistinct("order_id"), F.countDistinct("customer_id"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = sales.hourly_by_arrow(lines.mapInArrow(count, lines.schema), 3)
    assert got.schema == want.schema and _rows(got) == _rows(want) and seen.value == len(rows)
    whole = sales.grouped_parts
    monkeypatch.setattr(sales, "grouped_parts", lambda *a: whole(*a, rows=20))
    assert _rows(sales.hourly_by_arrow(lines.repartition(8), 2)) == _rows(want)


def test_slices_are_written_once(spark, monkeypatch):
    """a slice was written, read, shuffled and written again before it arrived."""
    monkeypatch.setattr(entry, "_arrive", None)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    t = load_base_tables(spark, SF_SMALL)
    got = entry.q_hourly_stream_price_change(spark, SF_SMALL)
    plain = ["sales_hour", "category", "subcategory", "total_orders", "unique_customers", "units_sold", "net_revenue"]
    want = decimals_to_double(sales.hourly_sales_metrics(t["orders"], t["products"]).select(*plain))
    assert sorted(map(str, got.select(*plain).collect())) == sorted(map(str, want.collect()))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
