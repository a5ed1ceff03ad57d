"""The pure streaming form of the hourly metrics (T3, T4).

* ``ArrivalRouter`` (foreachBatch) gives every arriving line the version of its
  product that was valid at the line's time, from a versions table that is read anew
  in each batch, and parts the lines at the watermark: those behind it go to a side
  table, the others to the folder that the metrics stream reads.
* ``exact_hourly_stream`` computes all 17 metrics per hour, category and subcategory.
  Distinct counts are exact.  Of a stream, a first stateful step keeps one row per order and one
  per customer in an hour, until the watermark has passed the hour; a second adds them up
  with the lines.  Spark puts all keys of a batch into that state before it drops those
  of closed hours, so memory grows with the batch.
* ``HourCloser`` (foreachBatch) therefore gives it tables instead of a stream: a batch's lines of hours that are
  closed now, with those kept from before.  Its state are the lines of the open hours, in files:
  it covers the delay, not the batch, and the groupings spill.
* ``repaired`` puts the side table's lines into their hours: only groups that have late
  lines are computed again, from the lines of their hours.  A Bloom filter of these groups
  keeps the lines and results of most others out of the exact joins.

The router's watermark and the stream's are the newest hour of the batches before less
the delay.  The stream may lag behind the router but never leads, so it drops nothing.
The closer's are the newest hour that it has read, which is the router's for the next batch.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercato.functions.timefn import hour_floor
from mercato.operators.bloom import bloom_filter, might_contain, wont_contain
from mercato.plans.sales import (
    ARROW_LINES, HOURLY_COLUMNS, hourly_by_arrow, hourly_metrics_of, hourly_of_timed, input_tasks, line_measures,
)
from mercato.session import task_slots
from mercato.sources import files

GROUP = ["sales_hour", "category", "subcategory"]
VERSION_COLUMNS = ["product_id", "category", "subcategory", "cost_price", "valid_from", "valid_to"]
_LINE = ("order_id long, customer_id long, quantity int, unit_price decimal(12,2), discount_pct decimal(5,2), "
         "status string, sales_hour timestamp_ntz, category string, subcategory string, cost_price decimal(12,2)")
REPAIR_BYTES = 2 << 20  # of routed lines a task
_FIELDS = [c.split()[0] for c in _LINE.split(", ")]


def as_of_join(lines: DataFrame, versions: DataFrame) -> DataFrame:
    """Lines with the product attributes valid at ``order_date``: from ``valid_from`` (null:
    always) up to, not including, ``valid_to`` (null: still).  Lines without a date take
    the version that is still valid; lines of unknown products or times drop out.  Versions of a
    product must not overlap."""
    v = versions.select(*VERSION_COLUMNS)
    inside = (F.coalesce(F.col("order_date") >= F.col("valid_from"), F.col("valid_from").isNull())
              & F.coalesce(F.col("order_date") < F.col("valid_to"), F.col("valid_to").isNull()))
    undated = F.col("order_date").isNull() & F.col("valid_to").isNull()
    return (lines.join(v, "product_id")
            .where(F.when(F.col("order_date").isNull(), undated).otherwise(inside))
            .withColumn("sales_hour", hour_floor("order_date"))
            .select(*_FIELDS))


class ArrivalRouter:
    """foreachBatch handler; see the module.  A batch is complete once its mark is
    written; until then a replay writes its folders again."""

    def __init__(self, versions: str, location: str, delay_hours: int):
        self.versions, self.location, self.delay = versions, location, _dt.timedelta(hours=delay_hours)
        self.on_time, self.late, self.marks = (f"{location}/{x}" for x in ("side=on_time", "side=late", "marks"))

    def watermark(self, spark: SparkSession, batch_id: int) -> _dt.datetime | None:
        """Newest hour of the batches before this one, less the delay."""
        before = [n for n in files.names(spark, self.marks) if int(n.split("=")[1]) < batch_id]
        if not before:
            return None
        text = files.read(spark, f"{self.marks}/{before[-1]}")  # marks never fall: the last is the highest
        return _dt.datetime.fromisoformat(text) - self.delay if text else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"{self.marks}/batch={batch_id:012d}"
        if files.exists(spark, mark):
            return
        at = self.watermark(spark, batch_id)
        lines = as_of_join(batch, spark.read.parquet(self.versions))
        behind = F.col("sales_hour").isNull()
        if at is not None:
            behind = behind | (F.col("sales_hour") <= F.lit(at).cast("timestamp_ntz"))
        for folder in (self.on_time, self.late):  # a side may get no line
            files.make_folder(spark, folder)
        # one pass joins, parts and measures the lines; only this batch's folders are replaced
        seen = Observation()
        (lines.observe(seen, F.max("sales_hour").alias("newest"))
         .withColumns({"side": F.when(behind, F.lit("late")).otherwise(F.lit("on_time")), "batch": F.lit(f"{batch_id:012d}")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("side", "batch").parquet(self.location))
        newest = seen.get.get("newest")
        before = at + self.delay if at is not None else None
        newest = max((x for x in (newest, before) if x is not None), default=None)
        files.write_once(spark, mark, newest.isoformat() if newest else "")


def line_stream(spark: SparkSession, location: str) -> DataFrame:
    """The routed lines as a stream; a batch takes all that has arrived."""
    return spark.readStream.schema(_LINE + ", batch string").parquet(location).drop("batch")


def read_lines(spark: SparkSession, location: str) -> DataFrame:
    """The routed lines of a folder as a table."""
    return spark.read.schema(_LINE + ", batch string").parquet(location).drop("batch")


def exact_hourly_stream(lines: DataFrame, delay: str, tasks: int | None = None) -> DataFrame:
    """All 17 metrics of a stream of routed lines, emitted once their hour lies behind
    the watermark; of a table of routed lines, whose hours are closed, the same without state
    (``tasks``: see hourly_by_arrow)."""
    if not lines.isStreaming:
        return (hourly_by_arrow(lines, tasks) if tasks else hourly_of_timed(lines)).select(*HOURLY_COLUMNS)
    hour = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', sales_hour)"))
    timed = lines.withColumn("event_hour", hour).withWatermark("event_hour", delay)
    group = ["event_hour", "category", "subcategory"]
    measures = line_measures()

    columns = {"order_once": "long", "customer_once": "long"} | {c: t for c, (_, t) in measures.items()}
    every = timed.select(*group, F.lit(None).cast("long").alias("order_once"),
                         F.lit(None).cast("long").alias("customer_once"),
                         *[e.cast(t).alias(c) for c, (e, t) in measures.items()])
    each = F.explode(F.array(F.struct(F.lit(True).alias("is_order"), F.col("order_id").alias("key")),
                             F.struct(F.lit(False).alias("is_order"), F.col("customer_id").alias("key"))))
    keys = (timed.select(*group, each.alias("k")).select(*group, "k.*").where("key IS NOT NULL")
            .dropDuplicates([*group, "is_order", "key"]))
    counts = {"order_once": F.when(F.col("is_order"), F.lit(1)), "customer_once": F.when(~F.col("is_order"), F.lit(1))}
    once = keys.select(*group, *[counts.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
    both = every.unionByName(once)
    out = hourly_metrics_of(both, group, F.coalesce(F.sum("order_once"), F.lit(0)).cast("long"),
                            F.coalesce(F.sum("customer_once"), F.lit(0)).cast("long"), measured=True)
    hours = F.expr("unix_micros(event_hour) div 3600000000").cast("int")
    ntz = F.timestamp_add("HOUR", hours, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
    return out.withColumn("sales_hour", ntz).select(*HOURLY_COLUMNS)


class HourCloser:
    """foreachBatch handler of the routed lines; see the module.  A batch is complete once its
    mark is written; until then a replay writes its folders again."""

    def __init__(self, location: str, delay_hours: int):
        self.location, self.delay = location, _dt.timedelta(hours=delay_hours)
        self.hours, self.open, self.marks = (f"{location}/{x}" for x in ("hours", "open", "marks"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"batch={batch_id:012d}"
        done = files.names(spark, self.marks)
        if name in done:
            return
        before = [n for n in done if n < name][-1:]
        text = files.read(spark, f"{self.marks}/{before[0]}") if before else ""
        newest = _dt.datetime.fromisoformat(text) if text else None
        behind = F.col("sales_hour").isNull()
        if newest is not None:
            behind = behind | (F.col("sales_hour") <= F.lit(newest - self.delay).cast("timestamp_ntz"))
        came, dropped, count = batch.agg(F.max("sales_hour"), F.count_if(behind), F.count(F.lit(1))).first()
        if dropped:  # their hours are closed, or never will be
            raise RuntimeError(f"{dropped} routed lines lie behind the watermark or have no hour")
        newest = max((x for x in (came, newest) if x is not None), default=None)
        lines = batch.select(*_FIELDS)
        if before:
            lines = lines.unionByName(read_lines(spark, f"{self.open}/{before[0]}"))
        closed = F.lit(False) if newest is None else F.col("sales_hour") <= F.lit(newest - self.delay).cast("timestamp_ntz")
        lines.where(~closed).write.mode("overwrite").parquet(f"{self.open}/{name}")
        tasks = max(task_slots(spark), -(-count // ARROW_LINES))
        (exact_hourly_stream(lines.where(closed), f"{self.delay.total_seconds()} seconds", tasks)
         .write.mode("overwrite").parquet(f"{self.hours}/{name}"))
        files.write_once(spark, f"{self.marks}/{name}", newest.isoformat() if newest else "")
        for old in before:  # a replay of this batch does nothing any more
            files.delete(spark, f"{self.open}/{old}")

    def closed_hours(self, spark: SparkSession) -> DataFrame:
        """The metrics of all hours that are closed, from complete batches."""
        return spark.read.parquet(*[f"{self.hours}/{n}" for n in files.names(spark, self.marks)]).select(*HOURLY_COLUMNS)


def repaired(hourly: DataFrame, on_time: DataFrame, late: DataFrame) -> DataFrame:
    """``hourly`` (from the stream) with the groups of the ``late`` lines computed again
    from all their lines."""
    concerned = late.select(*GROUP).distinct()
    bloom = bloom_filter(concerned, GROUP)
    # joins that add a column, as a semi or anti join would be moved below the filter's join
    mark = concerned.select(*[F.col(c).alias(f"_{c}") for c in GROUP], F.lit(True).alias("_late")).hint("shuffle_hash")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in GROUP]
    # groups that only the filter takes for late ones are computed too, and dropped as single rows: the lines
    # themselves are not joined
    lines = might_contain(on_time, bloom, GROUP).select(*late.columns).unionByName(late)
    tasks = input_tasks(lines, REPAIR_BYTES)
    again = (hourly_by_arrow(lines, tasks) if tasks else hourly_of_timed(lines)).join(mark, same)
    kept = (wont_contain(hourly, bloom, GROUP).select(*HOURLY_COLUMNS)
            .unionByName(might_contain(hourly, bloom, GROUP).join(mark, same, "left").where("_late IS NULL")
                         .select(*HOURLY_COLUMNS)))
    return kept.unionByName(again.select(*HOURLY_COLUMNS))


def close_hours(spark: SparkSession, on_time: str, after: _dt.datetime, n: int = 2) -> None:
    """End a finite feed: rows dated ``after`` move the stream's watermark on.  They are dated
    behind every real hour and never close themselves."""
    for k in range(n):
        row = tuple(after + _dt.timedelta(hours=k) if c == "sales_hour" else None for c in _FIELDS)
        spark.createDataFrame([row], _LINE).coalesce(1).write.parquet(f"{on_time}/batch=close-{k}")
