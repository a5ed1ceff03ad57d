"""Sharding along a Hilbert curve.

Metadata dimensions (language, source, length) are quantised to ``2 ** ORDER`` steps
each by the rank of their value, the steps are turned into an index on the Hilbert curve, and the rows, sorted by that index,
are cut into runs of equal row count (law ``rows``: counts differ by one at most).
A run covers a compact region in every dimension, so the minima and maxima in its
files let a reader skip files by any of them.

All of it is SQL functions.  The place of a row is its rank in (cell, bucket,
doc_id) order, found without a global sort: rows are counted per (cell, bucket),
the counts are summed up along the curve, and rows are ranked inside their bucket
only.  A cell that holds a third of all rows is dealt over its buckets, whose number
follows the rows of the table, by a hash of id and text.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import scratch_path

ORDER = 4  # bits per dimension; three dimensions give 4,096 cells
BUCKETS = 64  # of a cell, at least: one for each BUCKET_ROWS rows of the table
BUCKET_ROWS = 20_000_000
BROADCAST_ROWS = 2_000_000  # of 32 bytes
SHARDS = 16
TASK_BYTES = 64 << 20  # of text for a task that places rows
_P = "__hb_"


def hilbert_index(dims: list[Column], order: int = ORDER) -> Column:
    """Index on the Hilbert curve of whole coordinates in [0, 2 ** order).

    The coordinates are turned into the curve's transposed form (undo the
    rotations of each level from the top bit down, then Gray-code) and their
    bits are interleaved.  Every step works on all rows with bitwise functions.
    """
    return F.expr(_hilbert_sql([f"`{_P}{i}`" for i in range(len(dims))], order))


def _hilbert_sql(names: list[str], order: int) -> str:
    """SQL that folds the levels over an array of the coordinates."""
    n = len(names)
    x = f"array({', '.join(names)})"
    for q in (1 << k for k in range(order - 1, 0, -1)):
        for i in range(n):
            # if the bit is set, invert the low bits of the first coordinate; else
            # exchange the low bits of the first and this coordinate
            x = (f"transform(array({x}), v -> IF((v[{i}] & {q}) <> 0, "
                 f"transform(v, (c, k) -> IF(k = 0, c ^ {q - 1}, c)), "
                 f"transform(v, (c, k) -> CASE WHEN {i} = 0 THEN c "
                 f"WHEN k = 0 THEN c ^ ((v[0] ^ v[{i}]) & {q - 1}) "
                 f"WHEN k = {i} THEN c ^ ((v[0] ^ v[{i}]) & {q - 1}) ELSE c END)))[0]")
    # Gray code: each coordinate is xored with those before it
    x = (f"transform(array({x}), v -> transform(v, (c, k) -> "
         f"aggregate(slice(v, 1, k + 1), 0, (s, e) -> s ^ e)))[0]")
    flip = " ^ ".join(f"IF((v[{n - 1}] & {q}) <> 0, {q - 1}, 0)"
                      for q in (1 << k for k in range(order - 1, 0, -1)))
    x = f"transform(array({x}), v -> transform(v, c -> c ^ ({flip or '0'})))[0]"
    bits = " + ".join(f"shiftleft(shiftright(v[{i}], {b}) & 1, {b * n + n - 1 - i})"
                      for b in range(order) for i in range(n))
    return f"transform(array({x}), v -> {bits})[0]"


def _value(docs: DataFrame, name: str) -> Column:
    has = F.col(f"`{name}`").cast("string") if name in docs.columns else F.lit(None).cast("string")
    return F.coalesce(has, F.lit(""))


def _code(value: Column, skip: int) -> Column:
    """The seven bytes of a string after the first ``skip`` as a number of the same order."""
    part = F.hex(F.substring(value.cast("binary"), skip + 1, 7))
    return F.conv(F.rpad(part, 14, "0"), 16, 10).cast("long")


class Scales:
    """Steps of each dimension by rank: the value of a row is held against splits that
    cut the sorted values into runs of equal row counts, so a step is a range of the
    column that a reader filters on, and frequent values have steps of their own.

    Languages and sources are compared by the seven bytes after what all values begin
    with.  ``bytes``, ``rows``: of all texts.
    """

    def __init__(self, docs: DataFrame, order: int = ORDER):
        names = ("lang", "source")
        ends = docs.agg(*[f(_value(docs, n)) for n in names for f in (F.min, F.max)]).first()
        self.skip = {n: len(os.path.commonprefix([(x or "").encode() for x in ends[2 * k:2 * k + 2]]))
                     for k, n in enumerate(names)}
        at = F.array(*[F.lit(k / (1 << order)) for k in range(1, 1 << order)])
        dims = self._dimensions(docs)
        found = docs.select(*[d.alias(f"d{k}") for k, d in enumerate(dims)],
                            F.octet_length(_value(docs, "text")).alias("bytes")).agg(
            *[F.percentile_approx(f"d{k}", at, 10_000) for k in range(len(dims))], F.sum("bytes"),
            F.count(F.lit(1))).first()
        self.splits, self.bytes, self.rows = [x or [] for x in found[:-2]], found[-2] or 0, found[-1]

    def _dimensions(self, docs: DataFrame) -> list[Column]:
        return [*[_code(_value(docs, n), skip) for n, skip in self.skip.items()],
                F.length(_value(docs, "text")).cast("long")]

    def steps(self, docs: DataFrame) -> list[Column]:
        """Step of each dimension: how many splits lie below the row's value."""
        def below(splits: list, value: Column) -> Column:
            if not splits:
                return F.lit(0)
            held = F.array(*[F.lit(s).cast("long") for s in splits])
            # the value is a row's lambda variable, so it is worked out once, not for each split
            return F.transform(F.array(value), lambda v: F.size(F.filter(held, lambda s: s < v)))[0].cast("int")

        return [below(splits, d) for splits, d in zip(self.splits, self._dimensions(docs))]


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
           order: int = ORDER, buckets: int | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, cell, shard, slot and grown_shard, in
    partitions along the curve.  Columns of those names are replaced.

    Null texts count as empty (size 1), null ids sort first; of rows with one id
    the order is by the text's hash, and repeated rows take neighbouring slots.
    Missing columns and null languages and sources count as the empty string.  Very long texts
    are carried whole; other columns are carried along.
    An empty table gives an empty result; fewer rows than shards leave the last
    shards empty.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in OUTPUT]
    text, key = F.coalesce(F.col("text"), F.lit("")).cast("binary"), F.col(f"`{id_col}`")
    scales = Scales(docs, order)
    dims = scales.steps(docs)
    buckets = buckets or max(BUCKETS, -(-scales.rows // BUCKET_ROWS))
    df = docs.select(*[F.col(f"`{c}`") for c in own], F.octet_length(text).cast("long").alias("__hb_size"),
                     F.crc32(text).alias("__hb_crc"), *[d.alias(f"{_P}{i}") for i, d in enumerate(dims)])
    df = df.select(*[F.col(f"`{c}`") for c in own], "__hb_size", "__hb_crc",
                   hilbert_index(dims, order).cast("int").alias("__hb_cell"),
                   F.pmod(F.xxhash64(key, "__hb_crc"), F.lit(buckets)).cast("int").alias("__hb_bucket"))
    counts = df.groupBy("__hb_cell", "__hb_bucket").agg(F.count(F.lit(1)).alias("n"))
    # at most cells * buckets rows from here on: sums inside a cell, then over the cells
    cells = counts.groupBy("__hb_cell").agg(F.sum("n").alias("n"))
    over = Window.orderBy("__hb_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.select("__hb_cell", (F.sum("n").over(over) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("__hb_cell").orderBy("__hb_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    starts = counts.join(F.broadcast(cells), "__hb_cell").select(
        "__hb_cell", "__hb_bucket", "total",
        (F.col("before") + F.sum("n").over(inside) - F.col("n")).alias("start"))
    small = buckets << (order * len(dims)) <= BROADCAST_ROWS  # cells and buckets there can be
    tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-scales.bytes // TASK_BYTES))
    dealt = df.repartitionByRange(tasks, "__hb_cell", "__hb_bucket")
    rank = Window.partitionBy("__hb_cell", "__hb_bucket").orderBy(
        key.asc_nulls_first(), "__hb_crc", "__hb_size")
    placed = (dealt.withColumn("__hb_rank", F.row_number().over(rank) - 1)
              .join(F.broadcast(starts) if small else starts, ["__hb_cell", "__hb_bucket"])
              .withColumn("__hb_at", F.col("start") + F.col("__hb_rank")))
    shard = F.expr(f"__hb_at * {shards} div total")
    # the first place of shard s is ceil(s * total / shards)
    first = F.expr(f"((__hb_at * {shards} div total) * total + {shards - 1}) div {shards}")
    return placed.select(
        *[F.col(f"`{c}`") for c in own], (F.col("__hb_size") + 1).alias("size"),
        F.col("__hb_crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("__hb_cell").alias("cell"), shard.cast("int").alias("shard"),
        (F.col("__hb_at") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


OUTPUT = ("size", "text_crc32", "law", "cell", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, shards: int = SHARDS, path: str | None = None) -> DataFrame:
    """Write ``docs`` as one folder per shard (files in slot order, as many as
    there are tasks along the run) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "hilbert-shards")
    placed = assign(docs, shards)
    (placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
    return spark.read.schema(placed.schema).parquet(path)
