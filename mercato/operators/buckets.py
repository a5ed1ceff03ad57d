"""Exact ``NTILE(n)`` of several scores over a whole table by boundary selection.

``F.ntile(n).over(Window.orderBy(...))`` has no partition key, so Spark moves every row
into one task.  But a bucket is told by its boundary: the sort key of its first
row.  There are only ``n - 1`` of them, found by distributed order statistics:

1. splits of each sort value by ``percentile_approx`` (one aggregate for all scores);
   a value that holds more than a split's share of the rows is a split itself;
2. exact counts of the cells that the splits make: the open ranges between them and the
   splits' own ties.  Adding them up tells the cell of each boundary and its place in there;
3. a cell of more than ``cell_rows`` rows is divided once more, by the tie-break;
4. the rows of those few cells are ranked, a cell to a task, which gives the boundary keys.

Then one narrow pass compares every row with the boundaries of all its scores: no
shuffle, no copy of the table.  Splits are literals once found, so every use sees the
same cells.  Equal to SQL ``NTILE`` with the same ORDER BY (tests compare both).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = 32
CELL_ROWS = 1_000_000


def bucket_starts(total: int, n: int) -> list[int]:
    """0-based position at which buckets 2, 3, ... begin; those past the end are left out."""
    q, r = divmod(total, n)
    starts = [b * q + min(b, r) for b in range(1, n)]
    return [s for s in starts if s < total]


def _splits(df: DataFrame, keys: dict[str, Column], by: Sequence[str] = ()) -> list:
    quantiles = F.array(*[F.lit(k / SPLITS) for k in range(1, SPLITS)])
    return df.groupBy(*by).agg(*[F.percentile_approx(k, quantiles, 10_000).alias(name) for name, k in keys.items()]).collect()


def _cell(key: Column, splits: list) -> Column:
    """2 k: between splits k - 1 and k; 2 k + 1: at split k; nulls come last."""
    if not splits:
        return F.when(key.isNull(), F.lit(1)).otherwise(F.lit(0))
    held = F.array(*[F.lit(s) for s in splits])
    below = F.size(F.filter(held, lambda s: s < key))
    return F.when(key.isNull(), F.lit(2 * len(splits) + 1)).otherwise(
        2 * below + F.array_contains(held, key).cast("int"))


def _find(counts: dict, starts: list[int]) -> list[tuple]:
    """(cell, place in the cell) of each position, from {cell: rows}."""
    out, cells = [], sorted(counts)
    for start in starts:
        before = 0
        for c in cells:
            if start < before + counts[c]:
                out.append((c, start - before))
                break
            before += counts[c]
    return out


def _sizes(cells: DataFrame) -> dict:
    """{(score, cell): rows}; a few hundred per score."""
    return {(r[0], r[1]): r.n for r in cells.groupBy("score", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}


def boundaries(df: DataFrame, n: int, scores: dict[str, Column], tie: Column,
               cell_rows: int = CELL_ROWS) -> dict[str, list]:
    """{score: [(key, tie) of the first row of each bucket but the first]}."""
    names = list(scores)
    found = _splits(df, scores)
    splits = {s: sorted(set(found[0][s] or [])) if found else [] for s in names}
    stacked = df.select(tie.alias("tie"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("score"), scores[s].cast("decimal(38,8)").alias("key"),
                 _cell(scores[s], splits[s]).alias("cell")) for s in names])).alias("s")).select("tie", "s.*")
    sizes = _sizes(stacked)
    wanted = []  # (score, boundary, cell, place)
    for s in names:
        counts = {c: k for (score, c), k in sizes.items() if score == s}
        for b, (cell, place) in enumerate(_find(counts, bucket_starts(sum(counts.values()), n))):
            wanted.append((s, b, cell, place))
    if not wanted:
        return {s: [] for s in names}

    def of(cells):  # cells is a list of (score, cell)
        inside = F.lit(False)
        for s, c in cells:
            inside = inside | ((F.col("score") == s) & (F.col("cell") == c))
        return stacked.where(inside)

    # large cells (a tie of many rows): once more by the tie-break, within equal keys
    large = sorted({(s, c) for s, _, c, _ in wanted if sizes[s, c] > cell_rows})
    rows = of(sorted({(s, c) for s, _, c, _ in wanted} - set(large))).withColumn("part", F.lit(0)) if (
        len(large) < len({(s, c) for s, _, c, _ in wanted})) else None
    places = {(s, b): (c, 0, place) for s, b, c, place in wanted}
    for s, c in large:
        one = of([(s, c)])
        at_split = c % 2 == 1  # all of one key
        key = F.col("tie") if at_split else F.col("key")
        inner = sorted(set((_splits(one, {"x": key}) or [[None]])[0][0] or []))
        parted = one.withColumn("part", _cell(key, inner))
        counts = {r.part: r.n for r in parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        mine = [(b, place) for score, b, cell, place in wanted if (score, cell) == (s, c)]
        hit = _find(counts, [place for _, place in mine])
        for (b, _), (part, place) in zip(mine, hit):
            places[s, b] = (c, part, place)
        parted = parted.where(F.col("part").isin(sorted({part for part, _ in hit})))
        rows = parted if rows is None else rows.unionByName(parted)

    place = F.row_number().over(Window.partitionBy("score", "cell", "part").orderBy(F.col("key").asc_nulls_last(), "tie")) - 1
    ask = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(c).alias("c"), F.lit(p).alias("p"), F.lit(k).cast("long").alias("k"))
                    for (s, _), (c, p, k) in places.items()])
    ranked = (rows.withColumn("place", place.cast("long"))
              .where(F.array_contains(ask, F.struct(F.col("score").alias("s"), F.col("cell").alias("c"),
                                                    F.col("part").alias("p"), F.col("place").alias("k")))))
    keys = {(r.score, r.cell, r.part, r.place): (r.key, r.tie) for r in ranked.collect()}  # a row per boundary
    return {s: [keys[(s, *places[s, b])] for b in range(n - 1) if (s, b) in places] for s in names}


def _not_before(key: Column, tie: Column, bound: tuple) -> Column:
    """Whether a row's (key, tie) is at or past a boundary; null keys come last."""
    at, tie_at = bound
    if at is None:
        return key.isNull() & (tie >= F.lit(tie_at))
    at = F.lit(at)
    return key.isNull() | (key > at) | ((key == at) & (tie >= F.lit(tie_at)))


def ntiles(df: DataFrame, n: int, scores: dict[str, Column], tie: Column, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add for each score ``NTILE(n) OVER (ORDER BY key ASC NULLS LAST, tie)``.

    ``scores``: name -> numeric sort key, ascending (negate for a descending one);
    ``tie``: unique, without nulls.  ``df`` is cached, as it is read some five times.
    """
    if n < 1:
        raise ValueError("ntile needs n >= 1")
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    found = boundaries(df, n, scores, tie, cell_rows)
    out = {}
    for s, key in scores.items():
        bucket = F.lit(1)
        for bound in found[s]:
            bucket = bucket + _not_before(key.cast("decimal(38,8)"), tie, bound).cast("int")
        out[s] = bucket
    return df.withColumns(out)
