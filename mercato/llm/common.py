"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import mercato
from mercato.session import scratch_path

# Functions travel to the executors whole: the package needn't be installed there.
cloudpickle.register_pickle_by_value(mercato)

WORD_CLASS = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_CLASS)
BATCH_ROWS = 512
_UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else."""
    return text.lower() if text.isascii() else text.translate(_UPPER_TO_LOWER)


def words_of(text: str) -> list[str]:
    """Words as WORD_CLASS finds them."""
    return text.split() if text.isascii() and not _ODD.search(text) else WORD.findall(text)


# str.split() also cuts at the four ASCII separators, which WORD_CLASS keeps.
_ODD = re.compile(r"[\x1c-\x1f]")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    lineage, survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]],
             schema: str) -> DataFrame:
    """``mapInArrow`` over dictionaries of columns.

    ``fn`` takes an iterator of ``{column: list}`` and yields the same.  A batch
    holds BATCH_ROWS rows (and 64 MB, Spark's own limit) at most, which bounds
    the memory of tables with very long texts.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    out = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches):
        def columns():
            for b in batches:
                if b.num_rows:
                    yield {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        for got in fn(columns()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def gathered(batches: Iterator[dict], rows: int) -> Iterator[dict]:
    """Batches of narrow columns joined until they hold ``rows`` rows."""
    held: dict = {}
    for b in batches:
        for k, v in b.items():
            held.setdefault(k, []).extend(v)
        if len(next(iter(held.values()))) >= rows:
            yield held
            held = {}
    if held:
        yield held


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for the undirected ``edges`` (a, b: long); the
    component is its smallest node.

    Smallest-label propagation with pointer jumping; each round is written to
    the shared folder, so a lost executor costs one round at most.  Labels are
    joined on the node, where AQE splits a hub; the minimum per node is
    combined before the shuffle.
    """
    both = (edges.where("a <> b").select("a", "b")
            .unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
            .distinct())
    both = materialise(both, f"{name}-edges")
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        low = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = low.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = materialise(
            low.join(up, "label").select("node", F.least("label", "up").alias("label"),
                                         (F.col("old") != F.least("label", "up")).alias("moved")),
            f"{name}-{step}")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
