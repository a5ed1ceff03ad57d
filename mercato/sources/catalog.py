"""External tables over existing files, snapshot refresh, schema probes,
and staging of the normalised orders table.

External tables are catalog entries over files that stay where they are:
``CREATE TABLE .. USING parquet LOCATION ..`` with no column list (the
schema comes from the files), read-only from our side.  Dropping such a
table never deletes its files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    for part in name.split("."):
        if not _NAME.match(part):
            raise ValueError(f"not a plain identifier: {name!r}")
    return name


def _path(location: str) -> str:
    if "'" in location:
        raise ValueError(f"quote in location: {location!r}")
    return location


def register_external_table(spark: SparkSession, name: str, location: str,
                            fmt: str = "parquet") -> DataFrame:
    """(Re)create ``name`` as an external table over ``location``.  Where the table
    stands already with the same columns and no partitions, only its location moves, so the name
    never goes missing."""
    name = _ident(name)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if spark.catalog.tableExists(name) and _same_columns(spark, name, location, fmt):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_path(location)}'")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {_ident(fmt)} LOCATION '{_path(location)}'")
    _recover_partitions(spark, name)
    return spark.table(name)


def _same_columns(spark: SparkSession, name: str, location: str, fmt: str) -> bool:
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        return False
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if detail.get("Provider", "").lower() != fmt.lower() or detail.get("Type") != "EXTERNAL":
        return False
    there = spark.read.format(fmt).load(location).schema
    return [(f.name, f.dataType) for f in there] == [(f.name, f.dataType) for f in spark.table(name).schema]


def _recover_partitions(spark: SparkSession, name: str) -> None:
    """Register partition folders found under a partitioned table's location."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def register_raw_tables(spark: SparkSession, sf_dir: str, database: str = "mercato_ext",
                        names=("region", "nation", "customer", "part", "orders", "lineitem"),
                        ) -> dict[str, DataFrame]:
    """External tables for the raw test tables of ``sf_dir``."""
    return {name: register_external_table(spark, f"{database}.{name}",
                                          f"{sf_dir.rstrip('/')}/{name}.parquet")
            for name in names}


def refresh_snapshot(spark: SparkSession, name: str, new_location: str | None = None) -> DataFrame:
    """Point an external table at a newer snapshot (or just re-list its
    files) and drop cached metadata, so readers see the new data."""
    name = _ident(name)
    if new_location is not None:
        partitioned = any(c.isPartition for c in spark.catalog.listColumns(name))
        if partitioned:
            # partition entries keep their old folders: re-register the table
            return register_external_table(spark, name, new_location)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_path(new_location)}'")
    spark.catalog.refreshTable(name)
    _recover_partitions(spark, name)
    return spark.table(name)


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, buckets: int = 4096) -> DataFrame:
    """(key, change): keys ``inserted`` into, ``deleted`` from or ``changed`` between two
    snapshots of a table; a key may have several rows, compared as a bag.

    Digests come first: rows are hashed and added up per bucket of keys, before any
    shuffle, so equal buckets cost one scan and no more.  Only the rows of buckets that differ are
    grouped by key and compared.  Null keys form one key; the two must have the same columns.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the snapshots have different columns")
    columns = sorted(old.columns)

    def hashed(df: DataFrame) -> DataFrame:
        # two hashes of a row: equal digests of unequal rows would need both to agree
        return df.select(F.col(f"`{key}`").alias("key"), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).alias("bucket"),
                         F.xxhash64(*[F.col(f"`{c}`") for c in columns],
                                    *[F.col(f"`{c}`").isNull() for c in columns]).alias("h"),
                         F.xxhash64(F.lit("second"), *[F.col(f"`{c}`") for c in reversed(columns)],
                                    *[F.col(f"`{c}`").isNull() for c in columns]).alias("g"))

    def digest(df: DataFrame, by: str) -> DataFrame:
        return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("s"),
                                  F.bit_xor("g").alias("x"))

    def apart(by: str):  # full outer join on a null-safe key
        a, b = digest(rows_old, by).alias("a"), digest(rows_new, by).alias("b")
        return (a.join(b, F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")), "full")
                .where(~(F.struct("a.n", "a.s", "a.x").eqNullSafe(F.struct("b.n", "b.s", "b.x")))))

    rows_old, rows_new = hashed(old), hashed(new)
    differing = apart("bucket").select(F.coalesce("a.bucket", "b.bucket").alias("bucket"))  # ``buckets`` rows at most
    rows_old, rows_new = (r.join(F.broadcast(differing), "bucket", "left_semi") for r in (rows_old, rows_new))
    return apart("key").select(
        F.coalesce("a.key", "b.key").alias(key),
        F.when(F.col("a.n").isNull(), "inserted").when(F.col("b.n").isNull(), "deleted").otherwise("changed").alias("change"))


def describe_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, col_name, data_type) for each DataFrame's schema.

    Schemas are metadata held by the driver; this makes a small table of
    them (one row per column).
    """
    rows = [(table, field.name, field.dataType.simpleString())
            for table, df in tables.items() for field in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, col_name string, data_type string")


def with_order_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))


def stage_orders(orders: DataFrame, location: str) -> DataFrame:
    """Write the normalised order lines once, partitioned by month.

    Later queries read a plain table: ``status`` is a real column (filters
    on it reach the Parquet scan) and month predicates prune partitions.
    Overwrites only the months present (dynamic partition overwrite).
    """
    spark = orders.sparkSession
    # Months are dealt to tasks, so each gets few, large files; AQE sizes the tasks from the
    # data volume and splits a large month.  Range partitions would do the joins of the
    # lines twice, for the bounds and for the rows.
    (with_order_month(orders).hint("rebalance", "order_month")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("order_month").parquet(location))
    return spark.read.parquet(location)
