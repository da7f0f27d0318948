"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import materialize, scratch_path, scratch_scope

# The separators of words in the results' definitions.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_SEPARATORS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and named columns only, so that other columns cannot clash; null text becomes empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends there and lost executors lose nothing."""
    return materialize(df, f"llm-{label}")


def store_alone(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` builds, stored; the tables that it stores on the way are deleted."""
    path = scratch_path(spark, f"llm-{label}")
    with scratch_scope(spark):
        return materialize(make(), label, path)


def hash_remainder(column: str, divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids leave none."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % divisor == remainder, F.lit(False))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, not at each of its mentions within array functions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch that returns the columns of its result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = work(batch)
                yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# Texts that are split at once, in characters: bounds the lists of pieces.
GROUP_CHARS = 2_000_000


def in_groups(batch: list[str], most: int = GROUP_CHARS):
    """Consecutive runs of texts of about ``most`` characters."""
    run, size = [], 0
    for t in batch:
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run
