"""Real streaming restarts, and CLV on the sparse-orders fixture variant."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_compare import compare, duck
from mercato.functions.money import decimals_to_double
from mercato.plans import customers as cust
from mercato.plans import sales
from mercato.sources import catalog
from mercato.sources.bindings import TEST_AS_OF, load_base_tables
from mercato.streaming import refresh
from sql_oracle import BASE, CLV, CLV_OUT


def _rows(df):
    return sorted((tuple(r) for r in decimals_to_double(df.select(*sales.HOURLY_COLUMNS)).collect()), key=str)


def test_stream_restart_processes_each_file_once(spark, scratch):
    t = load_base_tables(spark, SF_SMALL)
    landing = f"{scratch}/landing"
    catalog.stage_orders(t["orders"], landing)
    handler = refresh.IncrementalHourlyRefresh(t["products"], f"{scratch}/base",
                                               f"{scratch}/result", f"{scratch}/history", "month")
    checkpoint = f"{scratch}/checkpoint"
    for _ in range(2):  # the second run finds every file already committed
        q = handler.start(refresh.order_stream(spark, landing, 3), checkpoint, available_now=True)
        q.awaitTermination()
    history = spark.read.parquet(f"{scratch}/history")
    assert history.agg(F.sum("input_rows")).first()[0] == t["orders"].count()
    assert _rows(refresh.read_hourly(spark, f"{scratch}/result")) == \
        _rows(sales.hourly_sales_metrics(t["orders"], t["products"]))


def test_clv_on_sparse_orders_matches_oracle(spark):
    """orders_sparse (FIXTURES.md): only every eighth order id, so some
    customers have no orders and every tier occurs.  Test-only fixture."""
    sf = "/root/testdata/sf0.01"
    t = load_base_tables(spark, sf)
    sparse = t["orders"].filter(F.col("order_id") % 8 == 0)
    import __spark_entry__ as entry
    got = entry._report(cust.clv(t["customers"], sparse, TEST_AS_OF))
    base = BASE.replace("JOIN part p ON l.l_partkey = p.p_partkey",
                        "JOIN part p ON l.l_partkey = p.p_partkey\n    WHERE l.l_orderkey % 8 = 0")
    ok, msg = compare(got, duck(sf), "WITH " + base + "," + CLV + CLV_OUT)
    assert ok, msg
    tiers = {r[0]: r[1] for r in got.groupBy("customer_tier").count().collect()}
    assert set(tiers) == {"Bronze", "Silver", "Gold", "Platinum"}
    assert got.filter(F.col("total_orders") == 0).count() > 0


def test_hourly_on_dense_orders_matches_oracle(spark):
    """orders_dense (FIXTURES.md): the same lines packed into 48 hours, so
    hourly groups hold many lines and both distinct counts are exercised."""
    from mercato.sources.bindings import orders_dense_from, read_raw
    from sql_oracle import HOURLY, HOURLY_OUT
    sf = "/root/testdata/sf0.01"
    raw = {n: read_raw(spark, sf, n) for n in ("lineitem", "orders", "part")}
    dense = orders_dense_from(raw["lineitem"], raw["orders"], raw["part"])
    got = decimals_to_double(sales.hourly_sales_metrics(dense, load_base_tables(spark, sf)["products"]))
    base = BASE.replace(
        "o.o_orderdate + to_seconds(CAST((o.o_orderkey * 37) % 86400 AS BIGINT)) AS order_date",
        "TIMESTAMP '2001-07-01 00:00:00' + to_hours(CAST((o.o_orderkey * 7919) % 48 AS BIGINT))"
        " AS order_date")
    ok, msg = compare(got, duck(sf), "WITH " + base + "," + HOURLY + HOURLY_OUT)
    assert ok, msg
    assert got.count() < 10000  # many lines per group


def _order(order_id, day, status="PENDING", quantity=2, product=1):
    import datetime
    from decimal import Decimal
    at = None if day is None else datetime.datetime(2001, 7, day, 10, 0)
    return (order_id, 1, product, quantity, Decimal("10.00"), Decimal("0.00"), at, status)


def test_incremental_equals_full_after_each_batch(spark, scratch):
    """Late and undated lines, an order sent again (same and other day), new products."""
    def products(ids):
        return spark.createDataFrame([(i, f"c{i}", "s", 3.0) for i in ids],
                                     "product_id long, category string, subcategory string, cost_price double")

    handler = refresh.IncrementalHourlyRefresh(products([1]), f"{scratch}/base", f"{scratch}/result")
    batches = [[_order(1, 3), _order(2, 3), _order(3, None)],
               [_order(1, 3, "COMPLETED"), _order(4, 1)],          # changed status, late day
               [_order(2, 5, "SHIPPED"), _order(5, 2, product=9)],  # moved to another day, unknown product
               [_order(4, 7)]]                                      # day 1 is left empty
    newest = {}
    for k, rows in enumerate(batches):
        handler(spark.createDataFrame(rows, refresh.ORDERS_SCHEMA), k)
        newest |= {r[0]: r for r in rows}
        full = sales.hourly_sales_metrics(
            spark.createDataFrame(list(newest.values()), refresh.ORDERS_SCHEMA), products([1]))
        assert _rows(refresh.read_hourly(spark, f"{scratch}/result")) == _rows(full)
    handler(spark.createDataFrame(batches[-1], refresh.ORDERS_SCHEMA), 3)  # a batch replayed
    handler.products_changed(spark, products([1, 9]))
    full = sales.hourly_sales_metrics(
        spark.createDataFrame(list(newest.values()), refresh.ORDERS_SCHEMA), products([1, 9]))
    got = decimals_to_double(refresh.read_hourly(spark, f"{scratch}/result").select(*sales.HOURLY_COLUMNS))
    assert sorted(map(str, got.collect())) == sorted(map(str, decimals_to_double(full).collect()))


def test_windowed_stream_does_not_depend_on_batches(spark, monkeypatch):
    import __spark_entry__ as entry
    t = load_base_tables(spark, SF_SMALL)
    want = _rows(sales.hourly_sales_metrics(t["orders"], t["products"]))
    for per_trigger in (10, 40):
        monkeypatch.setattr(entry, "FILES_PER_TRIGGER", per_trigger)
        assert _rows(entry.q_hourly_stream_windowed(spark, SF_SMALL)) == want


def test_money_is_rounded_never_cut(spark):
    from decimal import Decimal
    from mercato.functions.money import sum_gross
    doubles = spark.createDataFrame([(1, 19.99), (3, 1.13), (1, -2.29)], "quantity int, unit_price double")
    assert doubles.agg(sum_gross().alias("s")).first().s == Decimal("21.09")
    finer = spark.createDataFrame([(1, Decimal("0.0199"))], "quantity int, unit_price decimal(12,4)")
    assert finer.agg(sum_gross().alias("s")).first().s == Decimal("0.02")
