"""Sums and exact distinct counts per group in one shuffle, by Arrow.

Rows are dealt by group, so a task has all rows of its groups and counts their distinct keys itself; each row
crosses one shuffle, not one for itself and one for each of its keys.  A task with more than ``ROWS`` rows (a very
large group, or few partitions) doesn't count: it hands on sums of ``ROWS`` rows at a time and the distinct keys of each,
and Spark's own grouping, which spills, makes them distinct.  So memory is bounded whatever the groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import mercato

cloudpickle.register_pickle_by_value(mercato)  # executors needn't have the package

ROWS = 1 << 18
LOW_BITS = 20


def grouped_parts(df: DataFrame, group: Sequence[str], keys: Sequence[str], sums: Sequence[str], counts: Sequence[str],
                  tasks: int, rows: int = ROWS) -> DataFrame:
    """Rows (group, kind, key, one column of 0 or more for each of ``keys``, ``_hi`` and ``_lo`` sums and ``_n`` for each
    of ``sums``, ``_n`` for each of ``counts``) that add up to the group's.  ``keys`` are LONG columns; ``kind`` is the
    number of the key of a row that stands for one key, else null.  A sum is ``hi * 2**20 + lo``; ``_n`` counts what isn't
    null.  ``sums`` and ``counts`` are LONG columns, ``sums`` below 2**62."""
    group, keys, sums, counts = list(group), list(keys), list(sums), list(counts)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    added = [*keys, *[f"{c}_{x}" for c in sums for x in ("hi", "lo", "n")], *[f"{c}_n" for c in counts]]
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in group], "kind int", "key long", *[f"`{c}` long" for c in added]])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = [], True
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) > rows:
                yield from out(pa.Table.from_batches(held), False)
                held, first = [], False
        if held:
            yield from out(pa.Table.from_batches(held), first)

    def out(t: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
        """``whole``: these are all rows of the task."""
        if not t.num_rows:
            return
        columns, wanted = {c: t[c] for c in group}, []
        for c in sums:
            columns |= {f"{c}_hi": pc.shift_right(t[c], LOW_BITS), f"{c}_lo": pc.bit_wise_and(t[c], (1 << LOW_BITS) - 1)}
            wanted += [(f"{c}_hi", "sum", pc.ScalarAggregateOptions(min_count=1)),
                       (f"{c}_lo", "sum", pc.ScalarAggregateOptions(min_count=1)), (f"{c}_hi", "count")]
        columns |= {c: t[c] for c in [*counts, *keys]}
        wanted += [(c, "count") for c in counts] + ([(c, "count_distinct") for c in keys] if whole else [])
        got = pa.table(columns).group_by(group, use_threads=False).aggregate(wanted)
        names = {f"{c}_{x}": f"{c}_{x}_sum" for c in sums for x in ("hi", "lo")} | {f"{c}_n": f"{c}_hi_count" for c in sums}
        names |= {f"{c}_n": f"{c}_count" for c in counts} | ({c: f"{c}_count_distinct" for c in keys} if whole else {})
        yield from shaped(got, {c: c for c in group} | names, None)
        if not whole:
            for k, c in enumerate(keys):
                some = t.select([*group, c]).filter(pc.is_valid(t[c])).group_by([*group, c], use_threads=False).aggregate([])
                yield from shaped(some, {x: x for x in group} | {"key": c}, k)

    def shaped(t: pa.Table, names: dict, kind: int | None) -> Iterator[pa.RecordBatch]:
        every = [*group, "kind", "key", *added]
        columns = [t[names[c]] if c in names else
                   pa.array([kind] * t.num_rows, pa.int32()) if c == "kind" else pa.nulls(t.num_rows, pa.int64()) for c in every]
        yield from pa.table(columns, names=every).to_batches()

    return df.select(*group, *keys, *sums, *counts).repartition(tasks, *group).mapInArrow(parts, schema)


def added_up(parts: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per group: the parts' columns added up, the keys' columns as exact distinct counts."""
    added = [c for c in parts.columns if c not in (*group, "kind", "key")]
    once = parts.groupBy(*group, "kind", "key").agg(*[F.sum(c).alias(c) for c in added])
    counts = {c: (F.coalesce(F.sum(c), F.lit(0)) + F.count_if(F.col("kind") == k)).cast("long") for k, c in enumerate(keys)}
    return once.groupBy(*group).agg(*[counts.get(c, F.sum(c)).alias(c) for c in added])
