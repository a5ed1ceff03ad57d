"""Bloom filter of a set of keys as a small DataFrame, in SQL functions only.

A key's hash picks one 64-bit block and three bits in it.  The filter is the table
(block, bits) of the blocks in use: ``MAX_BLOCKS`` rows of 16 bytes at most, so it may be
broadcast whatever the size of the set; a fuller filter only lets more rows through.
It drops most rows that an exact join would have to shuffle; the join still decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BLOCKS = 1 << 18


def _place(keys: Sequence[Column | str], blocks: int) -> tuple[Column, Column]:
    h = F.xxhash64(*keys)
    one = [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(_bloom_hash, {64 - 6 * k}) & 63 AS INT))") for k in (1, 2, 3)]
    return h, one[0].bitwiseOR(one[1]).bitwiseOR(one[2])


def bloom_filter(df: DataFrame, keys: Sequence[Column | str], blocks: int = MAX_BLOCKS) -> DataFrame:
    """(_bloom_block, _bloom_bits) of the keys of ``df``."""
    h, bits = _place(keys, blocks)
    return (df.select(h.alias("_bloom_hash"))
            .select(F.pmod("_bloom_hash", F.lit(blocks)).alias("_bloom_block"), bits.alias("_bits"))
            .groupBy("_bloom_block").agg(F.bit_or("_bits").alias("_bloom_bits")))


def might_contain(df: DataFrame, bloom: DataFrame, keys: Sequence[Column | str],
                  blocks: int = MAX_BLOCKS) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter: all that are, few that aren't."""
    return _looked_up(df, bloom, keys, blocks, "inner").where(_FOUND).drop(*_WORK)


def wont_contain(df: DataFrame, bloom: DataFrame, keys: Sequence[Column | str],
                 blocks: int = MAX_BLOCKS) -> DataFrame:
    """The other rows of ``df``: none whose key is in the filter."""
    return _looked_up(df, bloom, keys, blocks, "left").where(~F.coalesce(F.expr(_FOUND), F.lit(False))).drop(*_WORK)


_WORK = ("_bloom_hash", "_bloom_block", "_bloom_bits", "_wanted")
_FOUND = "(_bloom_bits & _wanted) = _wanted"


def _looked_up(df: DataFrame, bloom: DataFrame, keys: Sequence[Column | str], blocks: int, how: str) -> DataFrame:
    h, bits = _place(keys, blocks)
    return (df.withColumn("_bloom_hash", h)
            .withColumn("_bloom_block", F.pmod("_bloom_hash", F.lit(blocks)))
            .join(F.broadcast(bloom), "_bloom_block", how)  # MAX_BLOCKS rows at most
            .withColumn("_wanted", bits))
