"""

Every query reads the raw test tables of ``sf_dir``, binds the three base
tables (``mercato.sources.bindings``) and runs one plan from
``mercato.plans`` / ``mercato.streaming``.  Money columns leave the library
as exact DECIMALs; here they are cast to DOUBLE (report form) so both
engines hand back the same types.
"""

from __future__ import annotations

import datetime
import sys
from collections.abc import Callable
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mercato.functions.money import decimals_to_double  # noqa: E402
from mercato.operators import quality  # noqa: E402
from mercato.plans import customers as cust  # noqa: E402
from mercato.plans import pipeline  # noqa: E402
from mercato.plans import products as prod  # noqa: E402
from mercato.plans import sales  # noqa: E402
from mercato.session import fewer_sorts, scratch_path  # noqa: E402
from mercato.sources import catalog, files, sinks  # noqa: E402
from mercato.sources.bindings import (  # noqa: E402
    RUN_STEPS_AS_OF, TEST_AS_OF, load_base_tables, orders_from, read_raw, run_steps_from,
)
from mercato.streaming import lag, refresh, windowed  # noqa: E402
from mercato.streaming.history import StreamHistory  # noqa: E402

# The operators of a training-data pipeline come as a subpackage of their own
# and may be absent; everything else works without them.
try:
    import corpus_pipeline
    from mercato.llm.queries import llm_oracle_sql, llm_queries
except ModuleNotFoundError as missing:
    if (missing.name or "").split(".")[0] not in ("mercato", "corpus_pipeline"):
        raise
    corpus_pipeline = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"
AS_OF = TEST_AS_OF
UNIT = "day"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return load_base_tables(spark, sf_dir)


# Integer columns that are NULL for some rows (no qualifying order).  Such
# columns become float64 in one engine's pandas export and nullable Int32 in
# the other's, so the report form carries them as DOUBLE on both sides.
NULLABLE_INTS = ("days_since_last_order",)


def _report(df: DataFrame) -> DataFrame:
    df = decimals_to_double(df)
    cast = [c for c in NULLABLE_INTS if c in df.columns]
    return df.withColumns({c: df[c].cast("double") for c in cast}) if cast else df


# ---------------------------------------------------------------- scans
def q_scan_customers(spark, sf_dir):
    return _report(_tables(spark, sf_dir)["customers"])


def q_scan_products(spark, sf_dir):
    return _report(_tables(spark, sf_dir)["products"])


def q_scan_orders(spark, sf_dir):
    return _report(_tables(spark, sf_dir)["orders"])


def q_base_row_counts(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return sales.base_row_counts(t["customers"], t["products"], t["orders"])


def q_recent_orders(spark, sf_dir):
    return _report(sales.recent_orders(_tables(spark, sf_dir)["orders"]))


def q_preview_orders(spark, sf_dir):
    orders = _tables(spark, sf_dir)["orders"]
    return _report(sales.preview_orders(orders.orderBy(*orders.columns)))


def q_recent_order_details(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return _report(sales.recent_order_details(t["orders"], t["customers"], t["products"]))


# ---------------------------------------------------------------- hourly
def _hourly(spark, sf_dir):
    return sales.hourly_of_lines(_tables(spark, sf_dir)["sales_lines"])


def q_hourly_sales_metrics(spark, sf_dir):
    return _report(_hourly(spark, sf_dir))


def q_hourly_margin_top20(spark, sf_dir):
    return _report(sales.hourly_margin_top(_hourly(spark, sf_dir), 20))


def q_daily_sales_summary(spark, sf_dir):
    return _report(sales.daily_sales_summary(_hourly(spark, sf_dir)))


# ---------------------------------------------------------------- customers
def _clv(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return cust.clv(t["customers"], t["sold_orders"], AS_OF)


def q_clv(spark, sf_dir):
    return _report(_clv(spark, sf_dir))


def q_tier_distribution(spark, sf_dir):
    return _report(cust.tier_distribution(_clv(spark, sf_dir)))


def q_top_customers_ltv(spark, sf_dir):
    return _report(cust.top_customers_ltv(_clv(spark, sf_dir)))


def q_top_platinum_customers(spark, sf_dir):
    return _report(cust.top_customers_in_tier(_clv(spark, sf_dir), "Platinum", 2))


def q_rfm_ntile(spark, sf_dir):
    return _report(cust.rfm_ntile(_tables(spark, sf_dir)["orders"], AS_OF))


# ---------------------------------------------------------------- products
def _performance(spark, sf_dir):
    return prod.performance_of_lines(_tables(spark, sf_dir)["sold_lines"])


def _analysis(spark, sf_dir):
    return prod.product_analysis(_performance(spark, sf_dir))


def q_category_performance(spark, sf_dir):
    return _report(_performance(spark, sf_dir))


def q_category_performance_top10(spark, sf_dir):
    return _report(prod.category_performance_top(_performance(spark, sf_dir), 10))


def q_product_analysis(spark, sf_dir):
    return _report(_analysis(spark, sf_dir))


def q_product_analysis_top15(spark, sf_dir):
    return _report(prod.product_analysis_top(_analysis(spark, sf_dir), 15))


def q_category_summary(spark, sf_dir):
    return _report(prod.category_summary(_analysis(spark, sf_dir)))


def q_product_category_analysis(spark, sf_dir):
    return _report(prod.product_category_analysis(_analysis(spark, sf_dir), AS_OF))


def q_best_margin_category(spark, sf_dir):
    return _report(prod.best_margin_category(_analysis(spark, sf_dir)))


def q_top_products(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return _report(prod.top_products(t["orders"], t["products"], 10))


def q_save_product_analysis(spark, sf_dir):
    pca = prod.product_category_analysis(_analysis(spark, sf_dir), AS_OF)
    return _report(sinks.save_table(pca, "product_category_analysis"))


def q_product_analysis_top10(spark, sf_dir):
    saved = q_save_product_analysis(spark, sf_dir)
    return prod.analysis_by_rank(saved, 10)


def q_save_clv(spark, sf_dir):
    """The build is tested before the name moves to it."""
    return _report(sinks.publish_table(_clv(spark, sf_dir), "customer_lifetime_value", _clv_checks, keep=10))


def _clv_checks(clv):
    return quality.quality_report(clv, unique=["customer_id"], not_null=["customer_id", "total_orders"],
                                  accepted={"customer_tier": cust.TIERS})


# ---------------------------------------------------------------- data quality
def _saved_clv(spark, sf_dir):
    """The table that was built: quality checks read its files."""
    return sinks.save_table(_clv(spark, sf_dir), "customer_lifetime_value")


def q_dq_clv_unique(spark, sf_dir):
    return quality.unique_check(_saved_clv(spark, sf_dir), "customer_id")


def q_dq_clv_not_null(spark, sf_dir):
    clv = _saved_clv(spark, sf_dir)
    return (quality.not_null_check(clv, "customer_id")
            .unionByName(quality.not_null_check(clv, "total_orders")))


def q_dq_clv_accepted_tier(spark, sf_dir):
    return quality.accepted_values_check(_saved_clv(spark, sf_dir), "customer_tier", cust.TIERS)


def q_dq_report(spark, sf_dir):
    return _clv_checks(_saved_clv(spark, sf_dir))


# ---------------------------------------------------------------- sources / catalog
def q_external_table_scan(spark, sf_dir):
    raw = catalog.register_raw_tables(spark, sf_dir, "mercato_ext",
                                      names=("part", "orders", "lineitem"))
    return _report(orders_from(raw["lineitem"], raw["orders"], raw["part"]))


def q_snapshot_refresh(spark, sf_dir):
    orders = _tables(spark, sf_dir)["orders"]
    # the older snapshot: every order still pending
    first = scratch_path(spark, "orders_snapshot")
    catalog.stage_orders(orders.withColumn("status", F.lit("PENDING")), first)
    catalog.register_external_table(spark, "ext_orders_snapshot", first)
    second = scratch_path(spark, "orders_snapshot")
    catalog.stage_orders(orders, second)
    return _report(catalog.refresh_snapshot(spark, "ext_orders_snapshot", second).drop("order_month"))


def q_snapshot_diff(spark, sf_dir):
    """What became of the orders between an older snapshot, some of whose orders were
    pending, missing or since deleted, and a newer one."""
    orders = _tables(spark, sf_dir)["orders"]
    first, second = scratch_path(spark, "orders_snapshot"), scratch_path(spark, "orders_snapshot")
    key = F.col("order_id")
    orders.where(key % 7 != 0).withColumn(
        "status", F.when(key % 11 == 0, F.lit("DRAFT")).otherwise(F.col("status"))).write.parquet(first)
    orders.where(key % 13 != 0).write.parquet(second)
    return catalog.diff_snapshots(spark.read.parquet(first), spark.read.parquet(second), "order_id")


# ---------------------------------------------------------------- refresh / streaming
def q_hourly_refresh_full(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return _report(refresh.refresh_full(t["orders"], t["products"],
                                        scratch_path(spark, "hourly_full"), UNIT))


# The feed: every line of the tables, in slices that arrive one after another.
FEED_CUTS = ("1997-06-01 00:00:00", "1999-06-01 00:00:00")
RESENT_EVERY = 50   # such orders come in an early form first and are sent again at the end
LATE_EVERY = 40     # such orders come one slice later than they should
DELAY_HOURS = 6
FILES_PER_TRIGGER = None  # a batch takes all that has arrived
PRICE_CHANGE = FEED_CUTS[0]


def _slice_of(c="order_date"):
    """Number of the slice that a line's date falls into; undated lines come first."""
    return sum(F.coalesce(F.col(c) >= F.to_timestamp_ntz(F.lit(at)), F.lit(False)).cast("int") for at in FEED_CUTS)


def _arrive(lines, landing):
    """New files of lines; AQE sizes them.  Range partitions would compute the lines twice, for the
    bounds and for the rows."""
    lines.hint("rebalance", "order_date", "order_id").write.mode("append").parquet(landing)


def _feed_with_resent(orders):
    """The slices as they arrive: orders divisible by RESENT_EVERY with one piece a line,
    pending and a day late at first, then once more as they are."""
    again = F.col("order_id") % RESENT_EVERY == 0
    early = orders.withColumns({
        "order_date": F.when(again, F.timestamp_add("DAY", F.lit(1), F.col("order_date"))).otherwise(F.col("order_date")),
        "quantity": F.when(again, F.lit(1)).otherwise(F.col("quantity")),
        "status": F.when(again, F.lit("PENDING")).otherwise(F.col("status")), "_slice": _slice_of()})
    return [*[early.where(F.col("_slice") == k).drop("_slice") for k in range(len(FEED_CUTS) + 1)], orders.where(again)]


def _run_incremental(spark, sf_dir):
    t = _tables(spark, sf_dir)
    staged = scratch_path(spark, "orders_staged")
    t["orders"].write.parquet(staged)  # joined once, read by every slice
    landing, checkpoint = scratch_path(spark, "orders_landing"), scratch_path(spark, "stream_checkpoint")
    result, history = scratch_path(spark, "hourly_incremental"), scratch_path(spark, "refresh_history")
    handler = refresh.IncrementalHourlyRefresh(t["products"], result, result, history, UNIT)
    for part in _feed_with_resent(spark.read.schema(refresh.ORDERS_SCHEMA).parquet(staged)):
        _arrive(part, landing)
        handler.start(refresh.order_stream(spark, landing, FILES_PER_TRIGGER), checkpoint, available_now=True).awaitTermination()
    return result, history


def q_hourly_refresh_incremental(spark, sf_dir):
    result, _ = _run_incremental(spark, sf_dir)
    return _report(refresh.read_hourly(spark, result))


def q_refresh_history(spark, sf_dir):
    """The history with its clock values as flags."""
    _, history = _run_incremental(spark, sf_dir)
    return refresh.refresh_history(spark, history, 10).select(
        "batch_id", "input_rows", "units_refreshed", "state",
        (F.col("refresh_end_time") >= F.col("refresh_start_time")).alias("has_duration"))


def q_hourly_refresh_when_due(spark, sf_dir):
    """Three looks at the input: all but the last slice, nothing new, the last slice."""
    t = _tables(spark, sf_dir)
    orders, products, result = (scratch_path(spark, x) for x in ("due_orders", "due_products", "due_hourly"))
    t["products"].write.parquet(products)
    due = lag.LagDrivenRefresh(orders, products, result, unit=UNIT)
    decisions = None
    last = len(FEED_CUTS)
    for look, part in enumerate((F.col("_slice") < last, None, F.col("_slice") == last)):
        if part is not None:
            _arrive(t["orders"].withColumn("_slice", _slice_of()).where(part).drop("_slice"), orders)
        one = due.refresh_when_due(spark).select(
            F.lit(look).alias("look"), "decision", "input_rows", "changed_files", "gone_files",
            (F.col("lag_seconds") >= 0).alias("lag_measured"))
        decisions = one if decisions is None else decisions.unionByName(one)
    rows, units = refresh.read_hourly(spark, result).agg(F.count(F.lit(1)), F.sum("units_sold")).first()
    return decisions.withColumns({"hourly_rows": F.lit(rows).cast("long"), "units_sold": F.lit(units).cast("long")})


def _stream_hours(spark, sf_dir, versions_at):
    """Run the routed feed through the windowed stream; ``versions_at(k)`` gives the product
    versions known when slice k arrives (None: as before)."""
    with fewer_sorts(spark):
        return _run_stream_hours(spark, sf_dir, versions_at)


def _run_stream_hours(spark, sf_dir, versions_at):
    t = _tables(spark, sf_dir)
    staged, landing, routed, out, versions = (scratch_path(spark, x) for x in (
        "orders_staged", "orders_landing", "orders_routed", "hourly_windowed", "product_versions"))
    checkpoints = [scratch_path(spark, "stream_checkpoint") for _ in range(2)]
    late = F.coalesce((F.col("order_id") % LATE_EVERY == 0).cast("int"), F.lit(0))
    # joined and written once; a slice arrives when its folder moves into the landing zone
    t["orders"].withColumn("_slice", _slice_of() + late).write.partitionBy("_slice").parquet(staged)
    files.make_folder(spark, landing)
    router, closer = windowed.ArrivalRouter(versions, routed, DELAY_HOURS), windowed.HourCloser(out, DELAY_HOURS)
    heard = StreamHistory()
    spark.streams.addListener(heard)

    def drain():
        query = (windowed.line_stream(spark, router.on_time).writeStream.foreachBatch(closer)
                 .option("checkpointLocation", checkpoints[1]).trigger(availableNow=True).start())
        query.awaitTermination()
        if not heard.finished(query) or heard.dropped():
            raise RuntimeError("the stream dropped lines that its router had let through")

    try:
        for k in range(len(FEED_CUTS) + 2):
            known = versions_at(k, t["products"])
            if known is not None:
                known.write.mode("overwrite").parquet(versions)
            if files.exists(spark, f"{staged}/_slice={k}"):
                files.move(spark, f"{staged}/_slice={k}", f"{landing}/slice-{k}")
            else:  # a slice may have no line
                files.make_folder(spark, f"{landing}/slice-{k}")
            (refresh.order_stream(spark, f"{landing}/*", FILES_PER_TRIGGER).writeStream.foreachBatch(router)
             .option("checkpointLocation", checkpoints[0]).trigger(availableNow=True).start().awaitTermination())
            drain()
        end = spark.read.schema(refresh.ORDERS_SCHEMA).parquet(f"{landing}/*").agg(F.max("order_date")).first()[0]
        windowed.close_hours(spark, router.on_time, end + datetime.timedelta(hours=DELAY_HOURS + 2))
        drain()
    finally:
        spark.streams.removeListener(heard)
    real = F.col("sales_hour") <= F.to_timestamp_ntz(F.lit(str(end)))
    on_time = windowed.read_lines(spark, router.on_time).where(real)
    return windowed.repaired(closer.closed_hours(spark), on_time, windowed.read_lines(spark, router.late))


def _first_versions(products):
    return products.withColumns({"valid_from": F.lit(None).cast("timestamp_ntz"),
                                 "valid_to": F.lit(None).cast("timestamp_ntz")})


def q_hourly_stream_windowed(spark, sf_dir):
    return _report(_stream_hours(spark, sf_dir, lambda k, products: _first_versions(products) if k == 0 else None))


def q_hourly_stream_price_change(spark, sf_dir):
    """Costs rise by a tenth at PRICE_CHANGE, which is known from the second slice on."""
    def versions_at(k, products):
        first = _first_versions(products)
        if k != 1:
            return first if k == 0 else None
        at = F.to_timestamp_ntz(F.lit(PRICE_CHANGE))
        dearer = F.round(F.col("cost_price") * F.lit(Decimal("1.1")), 2).cast("decimal(12,2)")
        return (first.withColumn("valid_to", at)
                .unionByName(first.withColumns({"valid_from": at, "cost_price": dearer})))
    return _report(_stream_hours(spark, sf_dir, versions_at))


# ---------------------------------------------------------------- pipeline / run log
def q_output_row_counts(spark, sf_dir):
    return pipeline.output_row_counts(_hourly(spark, sf_dir), _clv(spark, sf_dir))


def q_run_step_history(spark, sf_dir):
    steps = run_steps_from(read_raw(spark, sf_dir, "events"))
    return pipeline.step_history(steps, RUN_STEPS_AS_OF, 24, 20)


def _run_rows(spark, sf_dir):
    """This run's rows of the log, clock values as null flags."""
    run_id = pipeline.run_pipeline(spark, _tables(spark, sf_dir), AS_OF, unit=UNIT)
    return spark.table(pipeline.RUN_LOG).where(F.col("run_id") == run_id)


def _flags(log):
    return log.select("pipeline_name", "status", "summary", F.col("started_at").isNotNull().alias("has_start"),
                      F.col("completed_at").isNotNull().alias("has_end"))


def q_run_log_append(spark, sf_dir):
    return _flags(_run_rows(spark, sf_dir))


def q_run_log_tail(spark, sf_dir):
    return _flags(pipeline.run_log_tail(_run_rows(spark, sf_dir), 10))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the saved product category analysis at sf0.001."""
    return q_product_category_analysis(spark, FLAGSHIP_SF_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus_pipeline is None:
        return _queries()
    return _queries() | llm_queries() | {"pipeline": corpus_pipeline.run}


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_customers": q_scan_customers,
        "scan_products": q_scan_products,
        "scan_orders": q_scan_orders,
        "base_row_counts": q_base_row_counts,
        "recent_orders": q_recent_orders,
        "preview_orders": q_preview_orders,
        "recent_order_details": q_recent_order_details,
        "hourly_sales_metrics": q_hourly_sales_metrics,
        "hourly_margin_top20": q_hourly_margin_top20,
        "daily_sales_summary": q_daily_sales_summary,
        "clv": q_clv,
        "tier_distribution": q_tier_distribution,
        "top_customers_ltv": q_top_customers_ltv,
        "top_platinum_customers": q_top_platinum_customers,
        "rfm_ntile": q_rfm_ntile,
        "category_performance": q_category_performance,
        "category_performance_top10": q_category_performance_top10,
        "product_analysis": q_product_analysis,
        "product_analysis_top15": q_product_analysis_top15,
        "category_summary": q_category_summary,
        "product_category_analysis": q_product_category_analysis,
        "best_margin_category": q_best_margin_category,
        "top_products": q_top_products,
        "save_product_analysis": q_save_product_analysis,
        "product_analysis_top10": q_product_analysis_top10,
        "save_clv": q_save_clv,
        "dq_clv_unique": q_dq_clv_unique,
        "dq_clv_not_null": q_dq_clv_not_null,
        "dq_clv_accepted_tier": q_dq_clv_accepted_tier,
        "dq_report": q_dq_report,
        "external_table_scan": q_external_table_scan,
        "snapshot_refresh": q_snapshot_refresh,
        "snapshot_diff": q_snapshot_diff,
        "hourly_refresh_full": q_hourly_refresh_full,
        "hourly_refresh_incremental": q_hourly_refresh_incremental,
        "refresh_history": q_refresh_history,
        "hourly_refresh_when_due": q_hourly_refresh_when_due,
        "hourly_stream_windowed": q_hourly_stream_windowed,
        "hourly_stream_price_change": q_hourly_stream_price_change,
        "output_row_counts": q_output_row_counts,
        "run_step_history": q_run_step_history,
        "run_log_append": q_run_log_append,
        "run_log_tail": q_run_log_tail,
    }


def oracle_sql() -> dict[str, str]:
    from sql_oracle import queries_sql
    sql = queries_sql()
    if corpus_pipeline is not None:
        sql |= llm_oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: sql[name] for name in queries() if name in sql}
