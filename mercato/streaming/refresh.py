"""Refreshing the hourly sales metrics table.

* ``refresh_full`` (T1): recompute everything, replace the table.
* ``IncrementalHourlyRefresh`` (T2, ``deltas``): a Structured Streaming query over
  arriving order files that applies each batch as differences.
* ``windowed`` (T3, T4): the pure streaming form, with a watermark, a side table for late
  lines and product versions.
* ``refresh_when_due`` (``lag``): look at the input's files and do nothing, an
  incremental or a full refresh.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from mercato.plans.sales import HOURLY_COLUMNS, hourly_sales_metrics
from mercato.sources import files
from mercato.streaming import deltas
from mercato.streaming.deltas import IncrementalHourlyRefresh
from mercato.streaming.history import HISTORY_SCHEMA, refresh_history
from mercato.streaming.lines import ORDERS_SCHEMA, UNDATED, UNITS, order_stream, unit_of

KEEP_VERSIONS = 10
UNIT_PARTITIONS = 1024  # before AQE joins small ones
_MARKS = "_versions"  # a file per complete version of a full refresh

def refresh_full(orders: DataFrame, products: DataFrame, location: str,
                 unit: str = "day") -> DataFrame:
    """Recompute all hourly metrics and replace the stored table: they are written as a new
    version, whose mark makes it the current one.  Readers of a version before keep its files
    (the last KEEP_VERSIONS stay), and so does another session that refreshes the same table."""
    spark = orders.sparkSession
    version = f"v-{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    # AQE sizes the writers, and a unit with a large catalog is written by several.  Range
    # partitions would add up all groups twice, for the bounds and for the rows.  With few units a
    # partition AQE splits only large units; it would cut every unit of a large partition.
    (hourly_sales_metrics(orders, products).withColumn("sales_unit", unit_of("sales_hour", unit))
     .hint("rebalance", UNIT_PARTITIONS, "sales_unit")
     .write.partitionBy("sales_unit").parquet(f"{location}/{version}"))
    files.write_once(spark, f"{location}/{_MARKS}/{version}", "")
    deltas.remove(spark, location)  # a full refresh replaces what an incremental one kept
    _clean(spark, location)
    return spark.read.parquet(f"{location}/{version}").select(*HOURLY_COLUMNS)


def _clean(spark: SparkSession, location: str) -> None:
    """Remove all but the last versions, and what writers that failed before them left."""
    marks = files.names(spark, f"{location}/{_MARKS}")
    for old in marks[:-KEEP_VERSIONS]:
        files.delete(spark, f"{location}/{_MARKS}/{old}")
    for old in files.names(spark, location) if marks[:-KEEP_VERSIONS] else []:
        if old.startswith("v-") and old < marks[-KEEP_VERSIONS]:
            files.delete(spark, f"{location}/{old}")


def read_hourly(spark: SparkSession, location: str) -> DataFrame:
    """The stored metrics, from a full refresh or from an incremental one."""
    if deltas.is_delta_table(spark, location):
        return deltas.read_metrics(spark, location)
    versions = files.names(spark, f"{location}/{_MARKS}")
    # without a mark: a table stored before there were versions
    return spark.read.parquet(f"{location}/{versions[-1]}" if versions else location).select(*HOURLY_COLUMNS)


__all__ = ["HISTORY_SCHEMA", "ORDERS_SCHEMA", "UNDATED", "UNITS", "IncrementalHourlyRefresh", "order_stream",
           "read_hourly", "refresh_full", "refresh_history", "unit_of"]
