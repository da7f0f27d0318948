"""Repeatable sampling and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_fraction(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A random share of the rows."""
    return df.sample(fraction=fraction, seed=seed)


def sample_keys(df: DataFrame, key: str, one_in: int = 10) -> DataFrame:
    """All rows of one key in ``one_in``, chosen by a hash of the key.

    The same keys are chosen in every table and every run.
    """
    digest = F.md5(F.col(key).cast("string"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % one_in
    return df.filter(bucket == 0)


def drop_duplicates_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key combination, the one with the lowest ``order``.

    The aggregation keeps one candidate per key in each map task, so a group
    of many copies is down to a few rows before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("_first"))
        .select(*keys, "_first.*")
        .select(*df.columns)
    )
