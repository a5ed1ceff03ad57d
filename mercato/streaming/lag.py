"""Refresh on demand (S10): keep the metrics within a target lag of their input.

``refresh_when_due`` compares the input's files (path, size, modification time, from Spark's
``_metadata``) with those of the last refresh and picks the least work that gives the
result of a full recompute:

* nothing has changed: NO_CHANGE, nothing is written;
* order files were added: INCREMENTAL, their lines are applied as one batch;
* products were added or changed: the lines of those products as well;
* order files were changed or are gone, or there was no refresh before: FULL.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources import files
from mercato.streaming.deltas import IncrementalHourlyRefresh
from mercato.streaming.lines import ORDERS_SCHEMA

INPUT_SCHEMA = "source string, path string, size long, modified timestamp"
REPORT_SCHEMA = ("decision string, added_files long, changed_files long, gone_files long, input_rows long, "
                 "newest_input timestamp, refreshed_at timestamp, lag_seconds double, target_lag_seconds double, "
                 "within_target boolean")


def input_files(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(source, path, size, modified) of the files behind the ``sources`` (name -> folder)."""
    every = None
    for name, location in sources.items():
        one = (spark.read.parquet(location)
               .select(F.lit(name).alias("source"), F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_size").alias("size"),
                       F.col("_metadata.file_modification_time").alias("modified")).distinct())
        every = one if every is None else every.unionByName(one)
    return every


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """(source, path, change): added, changed or gone; files that stayed aren't listed."""
    b, n = before.alias("b"), now.alias("n")
    both = b.join(n, (F.col("b.source") == F.col("n.source")) & (F.col("b.path") == F.col("n.path")), "full")
    change = (F.when(F.col("b.path").isNull(), "added").when(F.col("n.path").isNull(), "gone")
              .when((F.col("b.size") != F.col("n.size")) | (F.col("b.modified") != F.col("n.modified")), "changed"))
    return both.select(F.coalesce("n.source", "b.source").alias("source"), F.coalesce("n.path", "b.path").alias("path"),
                       change.alias("change")).where("change IS NOT NULL")


class LagDrivenRefresh:
    """Keeps the metrics below ``result`` fresh from two folders of Parquet files."""

    def __init__(self, orders: str, products: str, result: str, history: str | None = None,
                 target_lag: _dt.timedelta = _dt.timedelta(minutes=5), unit: str = "day"):
        self.sources = {"orders": orders, "products": products}
        self.result, self.history, self.target_lag, self.unit = result, history, target_lag, unit

    def _seen(self, spark: SparkSession, name: str | None = None) -> tuple[str | None, DataFrame]:
        """What the last refresh had read; empty before the first."""
        found = files.names(spark, f"{self.result}/_inputs")
        if not found:
            return None, spark.createDataFrame([], INPUT_SCHEMA)
        return found[-1], spark.read.schema(INPUT_SCHEMA).parquet(f"{self.result}/_inputs/{found[-1]}")

    def _products(self, spark: SparkSession, version: str | None) -> DataFrame:
        """The products that the stored metrics were computed with."""
        return spark.read.parquet(f"{self.result}/_products/{version}" if version else self.sources["products"])

    def refresh_when_due(self, spark: SparkSession) -> DataFrame:
        """One row: what was decided, and how far the metrics lay behind their input."""
        version, before = self._seen(spark)
        now = input_files(spark, self.sources).persist()
        try:
            found = changed_files(before, now).persist()
            counts = {(r.source, r.change): r.n for r in
                      found.groupBy("source", "change").agg(F.count(F.lit(1)).alias("n")).collect()}
            newest = now.agg(F.max("modified")).first()[0]
            orders = {c: counts.get(("orders", c), 0) for c in ("added", "changed", "gone")}
            products = sum(n for (s, _), n in counts.items() if s == "products")
            rows = 0
            if not counts:
                decision = "NO_CHANGE"
            else:
                full = version is None or orders["changed"] or orders["gone"]
                decision = "FULL" if full else "INCREMENTAL"
                handler = IncrementalHourlyRefresh(self._products(spark, None if full else version), self.result,
                                                   self.result, self.history, self.unit)
                if full:
                    handler.forget(spark)
                added = [r.path for r in found.where("source = 'orders' AND change <> 'gone'").collect()] if not full else []
                if full or added:
                    # a first refresh lists folders, not files
                    batch = spark.read.schema(ORDERS_SCHEMA).parquet(*(added or [self.sources["orders"]]))
                    rows = batch.count()
                    handler.apply(batch, handler.last_batch(spark) + 1)
                if products and not full:
                    handler.products_changed(spark, spark.read.parquet(self.sources["products"]))
                self._remember(spark, now)
            found.unpersist()
            done = _dt.datetime.now(_dt.timezone.utc)
            waited = (done - newest.astimezone(_dt.timezone.utc)).total_seconds() if counts and newest else 0.0
            target = self.target_lag.total_seconds()
            every = [sum(n for (_, c), n in counts.items() if c == change) for change in ("added", "changed", "gone")]
            return spark.createDataFrame([(decision, *every, rows, newest, done if counts else None, waited, target,
                                           waited <= target)], REPORT_SCHEMA)
        finally:
            now.unpersist()

    def _remember(self, spark: SparkSession, now: DataFrame) -> None:
        stamp = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"
        spark.read.parquet(self.sources["products"]).write.parquet(f"{self.result}/_products/{stamp}")
        now.coalesce(1).write.parquet(f"{self.result}/_inputs/{stamp}")  # written last: names the products too
        for folder in ("_inputs", "_products"):
            for old in files.names(spark, f"{self.result}/{folder}")[:-2]:
                files.delete(spark, f"{self.result}/{folder}/{old}")
