"""Pipeline run log, output row counts and run-step history.

The source pipeline writes a STARTED row, refreshes three outputs, then a
finish row.  Here one run id is shared by both rows of a run and the finish
row carries the true status (COMPLETED or FAILED), see SURVEY C6.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.timefn import as_of_col, seconds_between
from mercato.sources.sinks import table_location

# The name and the messages that the log is expected to hold.
PIPELINE_NAME = "e-commerce_analytics"
RUN_LOG = "pipeline_run_log"


def ensure_run_log(spark: SparkSession, name: str = RUN_LOG,
                   location: str | None = None) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with ``created_at`` defaulting to now."""
    location = location or table_location(spark, name)
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            run_id STRING,
            pipeline_name STRING,
            status STRING,
            started_at TIMESTAMP,
            completed_at TIMESTAMP,
            summary STRING,
            created_at TIMESTAMP DEFAULT current_timestamp()
        ) USING parquet LOCATION '{location}'""")
    return spark.table(name)


def log_event(spark: SparkSession, run_id: str, status: str, name: str = RUN_LOG,
              summary: str | None = None, pipeline: str = PIPELINE_NAME) -> None:
    """INSERT one run-log row; the start row sets started_at, others completed_at."""
    time_col = "started_at" if status == "STARTED" else "completed_at"
    spark.sql(f"""
        INSERT INTO {name} (run_id, pipeline_name, status, {time_col}, summary)
        SELECT :run_id, :pipeline, :status, current_timestamp(), CAST(:summary AS STRING)""",
              args={"run_id": run_id, "pipeline": pipeline, "status": status, "summary": summary})


def new_run_id() -> str:
    return str(uuid.uuid4())


def output_row_counts(hourly: DataFrame, clv_table: DataFrame) -> DataFrame:
    """Row counts of the refreshed outputs, with the step messages."""
    def counted(name: str, df: DataFrame, prefix: str) -> DataFrame:
        return (df.agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(name).alias("output_name"), "row_count",
                        F.concat(F.lit(prefix), F.col("row_count").cast("string"))
                        .alias("message")))
    return (counted("dt_hourly_sales_metrics", hourly, "DT refreshed. Records: ")
            .unionByName(counted("customer_lifetime_value", clv_table,
                                 "dbt completed. CLV records: ")))


def run_log_tail(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.col("created_at").desc_nulls_last(), "run_id", "status").limit(n)


def step_history(steps: DataFrame, as_of=None, hours: int = 24, n: int = 20) -> DataFrame:
    """Steps started in the last ``hours`` before ``as_of``, newest first,
    with their duration in whole seconds."""
    now = as_of_col(as_of)
    since = F.timestamp_add("HOUR", F.lit(-hours), now)
    return (
        steps.filter(F.col("started_at") >= since)
        .select("run_id", "name", "started_at", "completed_at",
                seconds_between("started_at", "completed_at").alias("duration_seconds"))
        .orderBy(F.col("started_at").desc_nulls_last(), "run_id")
        .limit(n)
    )


def steps_from_run_log(log: DataFrame) -> DataFrame:
    """Pair each run's start and finish rows: (run_id, name, started_at, completed_at,
    state, message): a run without a finish row is still STARTED, the message of a
    FAILED one is its error."""
    return (log.groupBy("run_id")
            .agg(F.first("pipeline_name", ignorenulls=True).alias("name"),
                 F.min("started_at").alias("started_at"),
                 F.max("completed_at").alias("completed_at"),
                 F.coalesce(F.max(F.when(F.col("status") != "STARTED", F.col("status"))),
                            F.lit("STARTED")).alias("state"),
                 F.max(F.when(F.col("status") != "STARTED", F.col("summary"))).alias("message")))


def run_pipeline(spark: SparkSession, tables: dict[str, DataFrame], as_of=None,
                 log_name: str = RUN_LOG, hourly_location: str | None = None,
                 unit: str = "day") -> str:
    """One pipeline run: start row, the three outputs, finish row.

    Returns the run id.  A failure in any step is logged as FAILED (with the
    error text) and re-raised.
    """
    from mercato.plans import customers as cust
    from mercato.plans import products as prod
    from mercato.session import scratch_path
    from mercato.sources.catalog import stage_orders
    from mercato.sources.sinks import save_table
    from mercato.streaming.refresh import refresh_full

    ensure_run_log(spark, log_name)
    run_id = new_run_id()
    log_event(spark, run_id, "STARTED", log_name)
    try:
        # the order lines are joined once and read three times
        orders = stage_orders(tables["orders"], scratch_path(spark, "run-orders"))
        hourly = refresh_full(orders, tables["products"],
                              hourly_location or table_location(spark, "dt_hourly_sales_metrics"),
                              unit)
        clv_table = save_table(cust.clv(tables["customers"], orders, as_of),
                               "customer_lifetime_value")
        analysis = prod.product_analysis(
            prod.category_performance(orders, tables["products"]))
        save_table(prod.product_category_analysis(analysis, as_of), "product_category_analysis")
        messages = [row["message"] for row in
                    output_row_counts(hourly, clv_table).orderBy("output_name").collect()]
    except Exception as exc:
        log_event(spark, run_id, "FAILED", log_name, summary=str(exc))
        raise
    log_event(spark, run_id, "COMPLETED", log_name, summary="; ".join(messages))
    return run_id
