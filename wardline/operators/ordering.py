"""Dense row numbers over a whole table and bounded lists built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.session import materialize, partitions_for

# monotonically_increasing_id keeps the partition above this bit, the row below.
_ROW_BITS = 33


def dense_sequence(df: DataFrame, order_by: list[str], name: str = "seq") -> DataFrame:
    """Zero-based row numbers over the whole table, without gathering its rows.

    Rows are range-partitioned and sorted, so a row's number is its place in
    its partition plus the rows of all earlier partitions. The placed rows are
    written once: range bounds come from a sample, and a second run of the plan
    could cut elsewhere. ``order_by`` has to end in a unique column; it also
    is what lets many rows with one leading value spread over partitions.
    """
    placed = materialize(
        _by_range(df, order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "sequence",
    ).withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    # One row per range partition: as many as shuffle partitions, whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row)
        .drop("_part", "_slot", "_before")
    )


def _by_range(df: DataFrame, order_by: list[str]) -> DataFrame:
    # The configured partition count, which adaptive execution may lower, unless
    # the input is too large for it.
    wanted = partitions_for(df)
    if wanted <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartitionByRange(*order_by)
    return df.repartitionByRange(wanted, *order_by)


def collect_segments(
    df: DataFrame,
    key: str,
    order_by: list[str],
    fields: list[str],
    name: str,
    segment_rows: int = 100_000,
) -> DataFrame:
    """Ordered lists per key, cut into segments of at most ``segment_rows`` entries.

    A list of all rows of a key has no bound. Here every row is kept, in order,
    and no list outgrows its segment: concatenating a key's segments by
    ``segment`` gives the full list.
    """
    numbered = dense_sequence(df.select(*dict.fromkeys([key, *order_by, *fields])), [key, *order_by])
    entry = F.struct("seq", F.struct(*fields).alias("entry"))
    return (
        numbered.withColumn("segment", F.expr(f"seq div {int(segment_rows)}"))
        .groupBy(key, "segment")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(key, "segment", F.col("_entries.entry").alias(name))
    )
