"""Table writers: overwrite a named table, read it back; test before publishing.

Named tables are external tables whose files sit in the warehouse, apart from
checkpoints, so that a later session finds them.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.session import storage_root
from mercato.sources import files
from mercato.sources.catalog import register_external_table


def table_location(spark: SparkSession, name: str) -> str:
    return f"{storage_root(spark)}/tables/{name.replace('.', '/')}"


def save_table(df: DataFrame, name: str, location: str | None = None,
               partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace table ``name`` with ``df``: the new version is written to a folder of
    its own, and the name points there only when it is complete, so readers of the
    old version keep their files."""
    return publish_table(df, name, None, location, partition_by, keep=10)


class FailedChecks(ValueError):
    """A build did not pass its checks; the table still shows the version before."""

    def __init__(self, name: str, failed: list):
        self.failed = failed
        super().__init__(f"{name}: " + ", ".join(f"{r.check_name}({r.column_name}): {r.failures} failures" for r in failed))


def publish_table(df: DataFrame, name: str, checks: Callable[[DataFrame], DataFrame] | None = None,
                  location: str | None = None, partition_by: tuple[str, ...] = (), keep: int = 3) -> DataFrame:
    """Build, test, publish: ``df`` is written as a new version, ``checks`` (rows
    check_name, column_name, failures; see ``operators.quality``) run on the files as
    written, and only if none fails does the name move to them.  A version that fails
    is removed and FailedChecks raised.  The last ``keep`` versions stay for readers
    that began before, and for going back; older ones are removed.
    """
    spark = df.sparkSession
    root = location or table_location(spark, name)
    version = f"v-{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"
    path = f"{root}/{version}"
    df.write.partitionBy(*partition_by).parquet(path)
    if checks is not None:
        failed = checks(spark.read.parquet(path)).where("failures > 0").collect()  # one row per check
        if failed:
            files.delete(spark, path)
            raise FailedChecks(name, failed)
    table = register_external_table(spark, name, path)
    for old in table_versions(spark, name, root)[:-keep]:
        files.delete(spark, f"{root}/{old}")
    return table


def table_versions(spark: SparkSession, name: str, location: str | None = None) -> list[str]:
    """Stored versions of a table, oldest first."""
    return [n for n in files.names(spark, location or table_location(spark, name)) if n.startswith("v-")]
