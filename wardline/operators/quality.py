"""Row counts, null counts and key checks, each in one pass."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself, or ValueError if it has no row. Reads no more than one row."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def null_profile(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """One row per column: ``table_name, column_name, row_count, null_count, null_rate``."""
    columns = columns or df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(f"`{c}`").alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("present"))
            for i, c in enumerate(columns)
        ]
    )
    nulls = F.col("row_count") - F.col("present")
    return counts.select(F.col("_rows").alias("row_count"), F.inline(entries)).select(
        F.lit(name).alias("table_name"),
        "column_name",
        "row_count",
        nulls.alias("null_count"),
        F.when(F.col("row_count") > 0, nulls / F.col("row_count")).alias("null_rate"),
    )


def columns_with_nulls(df: DataFrame, name: str) -> DataFrame:
    return null_profile(df, name).filter(F.col("null_count") > 0)


def validate(df: DataFrame, name: str) -> int:
    """Row count of a frame that must not be empty; columns with nulls are logged.

    The profile has one row per column, so bringing it to the driver is bounded.
    """
    profile = null_profile(df, name).collect()
    rows = profile[0]["row_count"]
    if rows == 0:
        raise ValueError(f"{name} has no rows")
    nulls = {r["column_name"]: r["null_count"] for r in profile if r["null_count"]}
    if nulls:
        log.warning("null counts in %s: %s", name, nulls)
    log.info("%s: %d rows", name, rows)
    return rows


def orphan_report(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str
) -> DataFrame:
    """How many child rows point to no parent row. Rows without a key count as child rows, not as orphans.

    Child rows are counted per key before the join, so a key that holds a large
    share of them travels as one row.
    """
    per_key = (
        child.groupBy(F.col(child_key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = parent.select(F.col(parent_key).alias("_key")).groupBy("_key").agg(
        F.count(F.lit(1)).alias("_known")
    )
    lost = F.col("_known").isNull() & F.col("_key").isNotNull()
    return (
        per_key.join(known, "_key", "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
            F.coalesce(F.sum(F.when(lost, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(lost).alias("orphan_keys"),
        )
        .select(F.lit(name).alias("relation"), "child_rows", "orphan_rows", "orphan_keys")
    )
