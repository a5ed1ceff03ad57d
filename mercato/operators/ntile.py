"""Exact ``NTILE(n)`` over a whole table without a single-partition window.

``F.ntile(n).over(Window.orderBy(...))`` has no partition key, so Spark
moves every row into one task.  This version keeps the data spread:

1. range-partition on the sort keys plus a unique tie-break and sort
   inside each partition (one shuffle, balanced because the tie-break makes
   every key distinct; without an explicit count AQE merges neighbouring
   ranges to its advisory size, which keeps the order);
2. tag each row with ``monotonically_increasing_id`` whose upper bits are
   the partition index and lower 33 bits the position inside it;
3. checkpoint that table (reliable storage below ``spark.checkpoint.dir``):
   range bounds are sampled, so the two uses below must see one
   materialisation, also after an executor loss;
4. count rows per partition (a table with one row per partition), turn the
   counts into start offsets, broadcast that tiny table back;
5. global position -> bucket by arithmetic: with ``q = N div n`` and
   ``r = N mod n`` the first ``r`` buckets hold ``q+1`` rows.

Equal to SQL ``NTILE`` with the same ORDER BY (tests compare both).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import checkpoint_root

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_of(position: Column, total: Column, n: int) -> Column:
    """1-based NTILE bucket of 0-based ``position`` among ``total`` rows."""
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total % F.lit(n)).cast("long")
    big = r * (q + 1)
    return (
        F.when(q == 0, position + 1)
        .when(position < big, F.floor(position / (q + 1)) + 1)
        .otherwise(r + F.floor((position - big) / q) + 1)
    ).cast("int")


def ntile(df: DataFrame, n: int, order_by: Sequence[Column | str], out_col: str,
          partitions: int | None = None) -> DataFrame:
    """Add ``out_col = NTILE(n) OVER (ORDER BY order_by)``.

    ``order_by`` must end in a unique key (a tie-break), otherwise the
    result, like SQL NTILE's, depends on the order of equal keys.
    """
    if n < 1:
        raise ValueError("ntile needs n >= 1")
    spark = df.sparkSession
    checkpoint_root(spark)  # makes sure a reliable checkpoint dir is set
    keys = [_col(c) for c in order_by]
    spread = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys))
    tagged = (spread.sortWithinPartitions(*keys)
              .withColumn("_nt_id", F.monotonically_increasing_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    # Reliable checkpoint writes by recomputing its input unless it is
    # cached; the cache only lives until the checkpoint files are written.
    ranked = tagged.checkpoint(eager=True)
    tagged.unpersist()
    ranked = ranked.withColumns({
        "_nt_part": F.shiftright("_nt_id", _POS_BITS),
        "_nt_pos": F.col("_nt_id").bitwiseAND(F.lit(_POS_MASK)),
    })
    before = Window.orderBy("_nt_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_nt_part").rowsBetween(Window.unboundedPreceding,
                                                        Window.unboundedFollowing)
    # One row per partition: bounded by `partitions`, safe to broadcast.
    offsets = (
        ranked.groupBy("_nt_part").agg(F.count(F.lit(1)).alias("_nt_n"))
        .select(
            "_nt_part",
            F.coalesce(F.sum("_nt_n").over(before), F.lit(0)).alias("_nt_start"),
            F.sum("_nt_n").over(everything).alias("_nt_total"),
        )
    )
    return (
        ranked.join(F.broadcast(offsets), "_nt_part")
        .withColumn(out_col, bucket_of(F.col("_nt_start") + F.col("_nt_pos"),
                                       F.col("_nt_total"), n))
        .drop("_nt_id", "_nt_part", "_nt_pos", "_nt_start", "_nt_total")
    )


def ntile_window(df: DataFrame, n: int, order_by: Sequence[Column | str],
                 out_col: str) -> DataFrame:
    """Built-in form (one partition); for small inputs and for checking."""
    return df.withColumn(out_col, F.ntile(n).over(Window.orderBy(*[_col(c) for c in order_by])))
