"""Parquet tables and small inline tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.schemas import VITAL_BANDS, VITAL_MAP, Band


def read_table(
    spark: SparkSession, base: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """Scan ``<base>/<name>.parquet``; a given schema saves reading a footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_tables(
    spark: SparkSession,
    base: str,
    names: tuple[str, ...] = ("chartevents", "d_items", "prescriptions", "icustays"),
) -> dict[str, DataFrame]:
    return {name: read_table(spark, base, name) for name in names}


def vital_map(spark: SparkSession, bands: tuple[Band, ...] = VITAL_BANDS) -> DataFrame:
    """Item id (as text) to vital name, one row per band."""
    return spark.createDataFrame([(str(b.itemid), b.vital_name) for b in bands], VITAL_MAP)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns that ``df`` has, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])


def spread_by_stay(
    df: DataFrame, partitions: int | None = None, salts: int = 1, key: str = "stay_id"
) -> DataFrame:
    """Hash-partition on the stay.

    With ``salts`` above 1 a stay's rows go to that many partitions, picked by
    the other columns, so that one stay with many rows does not fill one task.
    The summaries here do not need this: they combine before they shuffle.
    """
    keys = [F.col(key)]
    if salts > 1:
        rest = [c for c in df.columns if c != key]
        keys.append(F.pmod(F.xxhash64(*rest), F.lit(salts)))
    return df.repartition(*keys) if partitions is None else df.repartition(partitions, *keys)
