"""Hourly metrics kept fresh by differences (T2).

Every batch is turned into signed rows: +1 for a line that comes, -1 for a line that
an order sent again (or removed) takes back.  All 17 metrics follow from amounts that
add up, so a batch costs its own lines, the old lines of the orders that it sends
again, and the counts of the keys that it touches; nothing is recomputed.

Four tables, each a set of immutable *runs* (Parquet folders):

* ``lines``: the lines as they came, with their batch;
* ``index``: (order_id, batch_id), the newest batch of each order.  A batch's
  orders are looked up through a Bloom filter and the range of their ids, and
  only the runs of ``lines`` that hold older versions are read;
* ``keys``: (hour, category, subcategory, kind, key, n), signed counts of the lines per order
  and per customer.  A distinct count changes by one where a key's sum leaves or reaches zero;
* ``sums``: (hour, category, subcategory, ...), signed sums and changes of the distinct counts.

The metrics table is the sum of ``sums`` per hour, category and subcategory.  A manifest
(one small file per commit, created once, never changed) names the live runs and the
last batch: a replayed batch finds itself committed and does nothing, a batch that
failed half-way leaves folders that no manifest names, and readers always see
the state after a whole batch.  ``fanout`` runs of a level are merged into one of the
next, so a batch reads at most ``fanout`` runs per level, however long the history.

An order's lines arrive in one batch; its newest batch replaces its older lines.  Lines
without an order_id are only ever added.  Lines without a date count under a null hour.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.money import ratio, sum_cost, sum_discount, sum_gross, sum_net
from mercato.functions.timefn import hour_floor
from mercato.operators.bloom import bloom_filter, might_contain, wont_contain
from mercato.plans.sales import HOURLY_COLUMNS, STATUSES
from mercato.sources import files
from mercato.streaming.history import record
from mercato.streaming.lines import ORDERS_SCHEMA, UNITS, unit_of

GROUP = ["sales_hour", "category", "subcategory"]
PRODUCT_COLUMNS = ["product_id", "category", "subcategory", "cost_price"]
_COUNTS = ["lines", "total_orders", "unique_customers", "units", "n_units", "n_gross", "n_net", "n_cost",
           *[f"{x.lower()}_orders" for x in STATUSES]]
_MONEY = {"gross": 2, "net": 6, "discounts": 6, "cost": 2}
_SUM_COLUMNS = [*GROUP, *_COUNTS, *_MONEY]
KEEP_MANIFESTS = 2  # what the last manifests name is kept, for readers that began before a merge


class Manifest:
    """The commit point of a refresh: which runs of each table are live."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.folder = spark, f"{location}/_manifest"

    def numbers(self) -> list[str]:
        return [n for n in files.names(self.spark, self.folder) if n.endswith(".json")]

    def load(self, name: str | None = None) -> dict:
        """The newest (or a named) state; an empty one before the first commit."""
        found = self.numbers()
        if not found:
            return {"version": -1, "last": -1, "tables": {}}
        return json.loads(files.read(self.spark, f"{self.folder}/{name or found[-1]}"))

    def commit(self, state: dict) -> None:
        files.write_once(self.spark, f"{self.folder}/{state['version']:012d}.json", json.dumps(state))

    def clean(self, root: str) -> None:
        """Remove old manifests, and runs that the last few don't name."""
        found = self.numbers()
        live = {r["name"] for n in found[-KEEP_MANIFESTS:] for t in self.load(n)["tables"].values() for r in t}
        for n in found[:-KEEP_MANIFESTS]:
            files.delete(self.spark, f"{self.folder}/{n}")
        for table in ("lines", "index", "keys", "sums"):
            for name in files.names(self.spark, f"{root}/{table}"):
                if f"{table}/{name}" not in live:
                    files.delete(self.spark, f"{root}/{table}/{name}")


def is_delta_table(spark: SparkSession, location: str) -> bool:
    return bool(Manifest(spark, location).numbers())


def remove(spark: SparkSession, location: str) -> None:
    """Remove the manifest, then the runs."""
    if is_delta_table(spark, location):
        for name in ("_manifest", "lines", "index", "keys", "sums"):
            files.delete(spark, f"{location}/{name}")


def read_metrics(spark: SparkSession, location: str) -> DataFrame:
    """The hourly metrics as of the last whole batch."""
    runs = Manifest(spark, location).load()["tables"].get("sums", [])
    return metrics_from(_read(spark, location, runs, _SUMS_SCHEMA))


def metrics_from(sums: DataFrame) -> DataFrame:
    """The 17 columns from signed sums."""
    total = _add_up(sums).where(F.col("lines") > 0)

    def known(c: str, count: str):  # a sum over no value is null
        return F.when(F.col(count) > 0, F.col(c))

    return total.select(
        *GROUP, "total_orders", "unique_customers", known("units", "n_units").alias("units_sold"),
        known("gross", "n_gross").alias("gross_revenue"), known("net", "n_net").alias("net_revenue"),
        known("discounts", "n_net").alias("total_discounts"),
        ratio(known("gross", "n_gross"), "n_gross").alias("avg_order_value"),
        ratio(known("units", "n_units"), "n_units").alias("avg_units_per_order"),
        known("cost", "n_cost").alias("total_cost"),
        (known("net", "n_net") - known("cost", "n_cost")).alias("gross_profit"),
        *[f"{x.lower()}_orders" for x in STATUSES]).select(*HOURLY_COLUMNS)


def _add_up(sums: DataFrame) -> DataFrame:
    return sums.groupBy(*GROUP).agg(
        *[F.sum(c).alias(c) for c in _COUNTS],
        *[F.sum(c).cast(f"decimal(38,{scale})").alias(c) for c, scale in _MONEY.items()])


_GROUP_SCHEMA = "sales_hour timestamp_ntz, category string, subcategory string"
_SUMS_SCHEMA = (_GROUP_SCHEMA + "".join(f", {c} long" for c in _COUNTS)
                + "".join(f", {c} decimal(38,{s})" for c, s in _MONEY.items()))
_KEYS_SCHEMA = _GROUP_SCHEMA + ", kind string, key long, n long"
_INDEX_SCHEMA = "order_id long, batch_id long"


def _read(spark: SparkSession, root: str, runs: list[dict], schema: str) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{r['name']}" for r in runs])


def signed_sums(joined: DataFrame, counted: DataFrame) -> DataFrame:
    """Sums per group of ``joined``: lines with product columns and ``sign`` (+1, -1), and of
    ``counted``: changes of the distinct counts.  One grouping, so that money is added up as
    whole numbers and made a decimal once."""
    signed = (joined.select(*GROUP, "sign", "quantity", "unit_price", "discount_pct", "cost_price", "status")
              .withColumn("_quantity", F.col("quantity") * F.col("sign"))
              .unionByName(counted, allowMissingColumns=True))
    priced = F.col("quantity").isNotNull() & F.col("unit_price").isNotNull()

    def count(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("sign"))), F.lit(0)).cast("long")

    money = {"gross": sum_gross("_quantity"), "net": sum_net("_quantity"),
             "discounts": sum_discount("_quantity"), "cost": sum_cost("_quantity")}
    return signed.groupBy(*GROUP).agg(
        F.coalesce(F.sum("sign"), F.lit(0)).cast("long").alias("lines"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("total_orders", "unique_customers")],
        F.coalesce(F.sum("_quantity"), F.lit(0)).cast("long").alias("units"),
        count(F.col("quantity").isNotNull()).alias("n_units"), count(priced).alias("n_gross"),
        count(priced & F.col("discount_pct").isNotNull()).alias("n_net"),
        count(F.col("quantity").isNotNull() & F.col("cost_price").isNotNull()).alias("n_cost"),
        *[count(F.col("status") == x).alias(f"{x.lower()}_orders") for x in STATUSES],
        *[F.coalesce(money[c], F.lit(0)).cast(f"decimal(38,{s})").alias(c) for c, s in _MONEY.items()])


def signed_keys(joined: DataFrame) -> DataFrame:
    """(group, kind, key, n): signed lines per order and per customer; 0 left out."""
    each = F.explode(F.array(F.struct(F.lit("order").alias("kind"), F.col("order_id").alias("key")),
                             F.struct(F.lit("customer").alias("kind"), F.col("customer_id").alias("key"))))
    return (joined.select(*GROUP, "sign", each.alias("k")).where("k.key IS NOT NULL")
            .groupBy(*GROUP, F.col("k.kind").alias("kind"), F.col("k.key").alias("key"))
            .agg(F.sum("sign").cast("long").alias("n")).where("n <> 0"))


def distinct_changes(changes: DataFrame, before: DataFrame | None) -> DataFrame:
    """(group, total_orders, unique_customers): by how much the distinct counts change when the
    signed counts ``changes`` (a row per key) are added to ``before`` (None: there are none;
    rows of other keys play no part).  A Bloom filter tells the keys that ``before`` may hold, only
    they are grouped with it.  One grouping serves as a join that treats nulls in the group as equal."""
    key = [*GROUP, "kind", "key"]
    now = changes.withColumn("was", F.lit(0).cast("long"))
    if before is not None:
        stored = bloom_filter(before, key)
        both = (might_contain(now, stored, key)
                .unionByName(before.withColumnRenamed("n", "was").withColumn("n", F.lit(0).cast("long"))))
        now = (wont_contain(now, stored, key)
               .unionByName(both.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("was").alias("was"))))
    flip = (F.col("was") + F.col("n") > 0).cast("long") - (F.col("was") > 0).cast("long")
    flips = now.where("n <> 0").withColumn("flip", flip).where("flip <> 0")

    def of(kind):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("flip"))), F.lit(0)).cast("long")

    return flips.groupBy(*GROUP).agg(of("order").alias("total_orders"), of("customer").alias("unique_customers"))


class DeltaStore:
    """Runs and manifest below ``location``, and the step that applies signed lines."""

    def __init__(self, spark: SparkSession, location: str, lines_schema: str, fanout: int = 8):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.location, self.fanout = spark, location, fanout
        self.schemas = {"lines": lines_schema, "index": _INDEX_SCHEMA, "keys": _KEYS_SCHEMA, "sums": _SUMS_SCHEMA}
        self.manifest = Manifest(spark, location)
        self.files_read = 0

    def table(self, state: dict, name: str, runs: list[dict] | None = None) -> DataFrame:
        runs = state["tables"].get(name, []) if runs is None else runs
        df = _read(self.spark, self.location, runs, self.schemas[name])
        if runs:
            self.files_read += len(df.inputFiles())
        return df

    def write(self, name: str, df: DataFrame, order: list[str], first: int, last: int, level: int = 0) -> dict:
        """A new run.  Stored lines and ids are clustered so that ranges of their key are ranges of
        files.  What a grouping made stays as it left it, sorted within files: a range
        partitioning would compute it twice, for the bounds and for the rows."""
        run = {"name": f"{name}/{uuid.uuid4().hex}", "level": level, "first": first, "last": last}
        if name in ("lines", "index"):
            df = df.repartitionByRange(*order)
        if name != "sums":  # always read whole
            df = df.sortWithinPartitions(*order)
        df.write.parquet(f"{self.location}/{run['name']}")
        return run

    # ---- what a batch reads
    def older_lines(self, state: dict, ids: DataFrame) -> DataFrame:
        """The current lines of the orders ``ids`` (order_id, distinct, not null)."""
        index = self.table(state, "index")
        ends = ids.agg(F.min("order_id"), F.max("order_id")).first()
        if ends[0] is None or not state["tables"].get("index"):
            return self.table(state, "lines", [])
        near = index.where(F.col("order_id").between(ends[0], ends[1]))
        hits = (might_contain(near, bloom_filter(ids, ["order_id"]), ["order_id"])
                .join(ids, "order_id")  # a semi join would be moved below the filter's join
                .groupBy("order_id").agg(F.max("batch_id").alias("batch_id")).persist())
        try:
            batches = [r[0] for r in hits.select("batch_id").distinct().collect()]  # one per batch at most
            runs = [r for r in state["tables"].get("lines", [])
                    if any(r["first"] <= b <= r["last"] for b in batches)]
            return (self.table(state, "lines", runs).where(F.col("order_id").between(ends[0], ends[1]))
                    .join(hits, ["order_id", "batch_id"], "left_semi"))
        finally:
            hits.unpersist()

    def counts_before(self, state: dict, changes: DataFrame) -> DataFrame | None:
        """Stored counts that may concern the keys of ``changes``: the span of their
        hours, then a Bloom filter; None before the first are stored."""
        if not state["tables"].get("keys"):
            return None
        hours = changes.agg(F.min("sales_hour"), F.max("sales_hour"), F.count_if(F.col("sales_hour").isNull())).first()
        keys = self.table(state, "keys")
        inside = F.lit(False)
        if hours[0] is not None:
            inside = F.col("sales_hour").between(F.lit(hours[0]).cast("timestamp_ntz"),
                                                 F.lit(hours[1]).cast("timestamp_ntz"))
        if hours[2]:
            inside = inside | F.col("sales_hour").isNull()
        key = [*GROUP, "kind", "key"]
        return might_contain(keys.where(inside), bloom_filter(changes, key), key)

    # ---- what a batch writes
    def apply(self, state: dict, joined: DataFrame, batch_id: int) -> dict:
        """Runs of ``keys`` and ``sums`` for the signed, joined lines."""
        changes, before = signed_keys(joined).persist(), None
        try:
            before = self.counts_before(state, changes)
            before = before.persist() if before is not None else None
            return {"keys": self.write("keys", changes, ["sales_hour"], batch_id, batch_id),
                    "sums": self.write("sums", signed_sums(joined, distinct_changes(changes, before)).select(*_SUM_COLUMNS),
                                       GROUP, batch_id, batch_id)}
        finally:
            for kept in (changes, before):
                if kept is not None:
                    kept.unpersist()

    def units(self, run: dict, unit: str) -> int:
        """Calendar units that a run of ``sums`` concerns."""
        hours = _read(self.spark, self.location, [run], _SUMS_SCHEMA).select("sales_hour").distinct()
        return hours.select(unit_of("sales_hour", unit)).distinct().count()

    def commit(self, state: dict, runs: dict, last: int) -> dict:
        tables = {t: [*state["tables"].get(t, []), *([runs[t]] if t in runs else [])] for t in self.schemas}
        new = {"version": state["version"] + 1, "last": last, "tables": tables}
        self.manifest.commit(new)
        return new

    # ---- merging
    def _merged(self, name: str, df: DataFrame) -> tuple[DataFrame, list[str]]:
        if name == "index":
            return df.groupBy("order_id").agg(F.max("batch_id").alias("batch_id")), ["order_id"]
        if name == "keys":
            return df.groupBy(*GROUP, "kind", "key").agg(F.sum("n").alias("n")).where("n <> 0"), ["sales_hour"]
        if name == "sums":
            return _add_up(df), GROUP
        return df, ["order_id"]

    def merge(self, state: dict) -> dict:
        """Fold each full level of each table into one run of the next."""
        tables = {t: list(runs) for t, runs in state["tables"].items()}
        changed = False
        for name, runs in tables.items():
            level = 0
            while any(r["level"] >= level for r in runs):
                full = [r for r in runs if r["level"] == level]
                if len(full) >= self.fanout:
                    df, order = self._merged(name, self.table(state, name, full))
                    one = self.write(name, df, order, min(r["first"] for r in full), max(r["last"] for r in full), level + 1)
                    runs[:] = [r for r in runs if r["level"] != level] + [one]
                    changed = True
                level += 1
        if not changed:
            return state
        new = {"version": state["version"] + 1, "last": state["last"], "tables": tables}
        self.manifest.commit(new)
        self.manifest.clean(self.location)
        return new


class IncrementalHourlyRefresh:
    """foreachBatch handler that keeps the metrics below ``result`` equal to a full
    recompute over the newest version of every order seen so far.

    ``history`` takes one row per batch, failed ones included; ``unit`` (day or month) is what its
    units_refreshed counts.  All state lies below ``result``; ``base`` is kept for
    callers of the earlier layout and not written.
    """

    def __init__(self, products: DataFrame, base: str, result: str, history: str | None = None,
                 unit: str = "day", fanout: int = 8):
        if unit not in UNITS:
            raise ValueError(f"unit must be one of {sorted(UNITS)}")
        self.products, self.result, self.history, self.unit, self.fanout = products, result, history, unit, fanout
        self.files_read = 0  # by the last batch

    def store(self, spark: SparkSession) -> DeltaStore:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS_SCHEMA.fields)
        return DeltaStore(spark, self.result, fields + ", batch_id long", self.fanout)

    def _joined(self, lines: DataFrame, products: DataFrame) -> DataFrame:
        return (lines.join(products.select(*PRODUCT_COLUMNS), "product_id")
                .withColumn("sales_hour", hour_floor("order_date")))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.apply(batch, batch_id)

    def apply(self, batch: DataFrame, batch_id: int, removed: DataFrame | None = None) -> None:
        """Take a batch of lines; ``removed`` (order_id) names orders that are gone."""
        spark = batch.sparkSession
        store = self.store(spark)
        state = store.manifest.load()
        if batch_id <= state["last"]:
            return  # committed before: a replay
        started = _dt.datetime.now(_dt.timezone.utc)
        lines = batch.select(*[c.split()[0] for c in store.schemas["lines"].split(", ")][:-1]).persist()
        try:
            n, units = self._take(store, state, lines, batch_id, removed)
        except Exception as problem:
            record(spark, self.history, batch_id, started, None, None, "FAILED", str(problem))
            raise
        finally:
            lines.unpersist()
        record(spark, self.history, batch_id, started, n, units, "SUCCEEDED" if n or removed is not None else "EMPTY")

    def _take(self, store: DeltaStore, state: dict, lines: DataFrame, batch_id: int, removed: DataFrame | None):
        n = lines.count()
        ids = lines.select("order_id")
        if removed is not None:
            ids = ids.unionByName(removed.select(F.col("order_id").cast("long").alias("order_id")))
        ids = ids.where("order_id IS NOT NULL").distinct().persist()
        try:
            older = store.older_lines(state, ids).persist()
            signed = (lines.withColumn("sign", F.lit(1))
                      .unionByName(older.drop("batch_id").withColumn("sign", F.lit(-1))))
            joined = self._joined(signed, self.products).persist()
            runs = {"lines": store.write("lines", lines.withColumn("batch_id", F.lit(batch_id).cast("long")),
                                         ["order_id"], batch_id, batch_id),
                    "index": store.write("index", ids.withColumn("batch_id", F.lit(batch_id).cast("long")),
                                         ["order_id"], batch_id, batch_id)}
            runs |= store.apply(state, joined, batch_id)
            units = store.units(runs["sums"], self.unit)
            self.files_read = store.files_read
            store.merge(store.commit(state, runs, batch_id))
        finally:
            for kept in (ids, older, joined):
                kept.unpersist()
        return n, units

    def last_batch(self, spark: SparkSession) -> int:
        """The last batch taken; -1 before the first."""
        return self.store(spark).manifest.load()["last"]

    def forget(self, spark: SparkSession) -> None:
        """Begin anew: from here on the metrics are those of the batches to come."""
        store = self.store(spark)
        state = store.manifest.load()
        if state["tables"]:
            store.manifest.commit({"version": state["version"] + 1, "last": state["last"], "tables": {}})

    def products_changed(self, spark: SparkSession, products: DataFrame) -> None:
        """Take new ``products``: the current lines of changed ones are taken back with
        the old attributes and added with the new."""
        store = self.store(spark)
        state = store.manifest.load()
        old, new = (p.select(*PRODUCT_COLUMNS) for p in (self.products, products))
        changed = old.exceptAll(new).unionByName(new.exceptAll(old)).select("product_id").distinct()
        hit = store.table(state, "lines").join(changed, "product_id", "left_semi")
        newest = store.table(state, "index").groupBy("order_id").agg(F.max("batch_id").alias("batch_id"))
        lines = (hit.where("order_id IS NOT NULL").join(newest, ["order_id", "batch_id"], "left_semi")
                 .unionByName(hit.where("order_id IS NULL")))
        joined = (self._joined(lines.withColumn("sign", F.lit(-1)), old)
                  .unionByName(self._joined(lines.withColumn("sign", F.lit(1)), new))).persist()
        try:
            store.merge(store.commit(state, store.apply(state, joined, state["last"]), state["last"]))
        finally:
            joined.unpersist()
        self.products = products

    def start(self, source: DataFrame, checkpoint: str, available_now: bool = False, interval: str = "5 minutes"):
        writer = source.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
        return writer.start()
