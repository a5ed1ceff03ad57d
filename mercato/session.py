"""Session defaults and shared storage locations.

The library never creates its own cluster settings for production: the
session is handed in.  ``local_session`` exists for tests and the bench.
Storage that must survive executor loss (checkpoints, staged tables,
stream state) lives below ``spark.checkpoint.dir``; tables and logs that must
survive the session live in the warehouse.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "mercato") -> SparkSession:
    """Session for tests and the bench (``local[cores]``)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf access differs by deployment
        value = None
    if not value:
        try:
            value = spark.sparkContext.getConf().get(key, None)
        except Exception:  # pragma: no cover
            value = None
    return value or None


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate data.

    ``spark.checkpoint.dir`` where the cluster names one.  A local session (tests,
    the bench) may do without: its checkpoint dir, or else one below the warehouse,
    is used.  Anything else raises: intermediate data on one machine's disk would
    be lost to the others.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    if root is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = context._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get().rstrip("/")
        root = storage_root(spark) + "/_checkpoints"
        context.setCheckpointDir(root)
    return root.rstrip("/")


def storage_root(spark: SparkSession) -> str:
    """Folder of durable tables and logs: the same in every session that has the
    same warehouse, and apart from checkpoints."""
    warehouse = _conf(spark, "spark.sql.warehouse.dir") or "spark-warehouse"
    if ":/" not in warehouse:
        warehouse = os.path.abspath(warehouse)
    return warehouse.rstrip("/") + "/mercato"


def task_slots(spark: SparkSession) -> int:
    """Tasks the cluster runs at once (``defaultParallelism``)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # pragma: no cover - no SparkContext (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# A join whose build side has at most so many bytes of shuffle in every task needs no sorts (AQE sees
# the sizes; where its advisory size is larger it sorts); partitioned writes of few folders neither.
_FEWER_SORTS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
                "spark.sql.maxConcurrentOutputFileWriters": "8"}


@contextmanager
def fewer_sorts(spark: SparkSession) -> Iterator[None]:
    """What runs inside joins and writes without sorts where that is safe; a session's own settings stay."""
    ours = {k: v for k, v in _FEWER_SORTS.items() if spark.conf.get(k) in ("0", "0b")}
    before = {k: spark.conf.get(k) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
