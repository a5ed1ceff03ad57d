"""Data-quality checks on a table: unique, not_null, accepted_values.

Each check returns one summary row ``(check_name, column_name, failures)``
where ``failures`` counts what a failing-rows test would return: duplicated
key values for ``unique``, NULL rows for ``not_null``, distinct
non-accepted values for ``accepted_values`` (NULL is accepted, as in SQL
``NOT IN``).  ``quality_report`` runs all column-local checks in a single
aggregate pass plus one grouped pass per uniqueness check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _summary(df: DataFrame, check: str, column: str, failures) -> DataFrame:
    return df.agg(failures.cast("long").alias("failures")).select(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "failures")


def unique_check(df: DataFrame, column: str) -> DataFrame:
    """Number of non-NULL values of ``column`` that occur more than once."""
    dupes = (df.filter(F.col(column).isNotNull()).groupBy(column)
             .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    return _summary(dupes, "unique", column, F.count(F.lit(1)))


def not_null_check(df: DataFrame, column: str) -> DataFrame:
    return _summary(df, "not_null", column, F.count_if(F.col(column).isNull()))


def accepted_values_check(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    bad = F.when(~F.col(column).isin(*values), F.col(column))
    return _summary(df, "accepted_values", column, F.count_distinct(bad))


def quality_report(df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = (),
                   accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """All checks as rows (check_name, column_name, failures, status)."""
    accepted = accepted or {}
    aggs, names = [], []
    for col in not_null:
        aggs.append(F.count_if(F.col(col).isNull()).cast("long"))
        names.append(("not_null", col))
    for col, values in accepted.items():
        aggs.append(F.count_distinct(F.when(~F.col(col).isin(*values), F.col(col))).cast("long"))
        names.append(("accepted_values", col))
    parts = []
    if aggs:
        wide = df.agg(*[a.alias(f"_c{i}") for i, a in enumerate(aggs)])
        stacked = F.inline(F.array(*[
            F.struct(F.lit(check).alias("check_name"), F.lit(col).alias("column_name"),
                     F.col(f"_c{i}").alias("failures"))
            for i, (check, col) in enumerate(names)
        ]))
        parts.append(wide.select(stacked))
    for col in unique:
        parts.append(unique_check(df, col))
    if not parts:
        raise ValueError("quality_report needs at least one check")
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.withColumn(
        "status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
