"""Comparing the content of two tables by fingerprints that do not depend on the order of rows.

The fingerprint of a column is the sum of a hash of each of its values, that of the rows the sum of a hash over all columns: equal
for equal multisets, and different, but for chance in some 2^64, where a value changed, moved to another row, was
doubled or lost. It is one aggregation a table, added up on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "(rows)"
# A hash is summed in parts of so many bits, so sums stay exact up to 2^41 rows.
_PART_BITS = 22
_PARTS = 3

CONTENT = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("rows_a", T.LongType()),
        T.StructField("rows_b", T.LongType()),
        T.StructField("same", T.BooleanType()),
    ]
)


def _hashable(name: str, kind: T.DataType) -> Column:
    """The column as a value whose hash tells nulls within it apart; maps go by their sorted entries, as they have no order."""
    column = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):
        column = F.array_sort(F.map_entries(column))
    if isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType)):
        return F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"}))
    return column


def _value_hash(name: str, kind: T.DataType) -> Column:
    """A hash of value and column; null has one of its own."""
    value = _hashable(name, kind)
    return F.xxhash64(F.lit(name), value.isNull(), value)


def _sums(hashed: Column) -> list[Column]:
    mask = (1 << _PART_BITS) - 1
    return [F.coalesce(F.sum(F.shiftrightunsigned(hashed, k * _PART_BITS).bitwiseAND(mask)), F.lit(0)) for k in range(_PARTS)]


def fingerprint(df: DataFrame) -> dict[str, tuple[int, ...]]:
    """Column name to (rows, sums of its hashes); ``ROWS`` has those of the whole rows."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    hashes = [_value_hash(f.name, f.dataType).alias(f"h{i}") for i, f in enumerate(fields)]
    hashed = df.select(*hashes)
    hashed = hashed.withColumn("rows", F.xxhash64(*hashed.columns) if fields else F.lit(0).cast("long"))
    sums = [s.alias(f"{c}_{k}") for c in hashed.columns for k, s in enumerate(_sums(F.col(c)))]
    found = hashed.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    of = {f.name: f"h{i}" for i, f in enumerate(fields)} | {ROWS: "rows"}
    return {name: (found["n"], *[found[f"{c}_{k}"] for k in range(_PARTS)]) for name, c in of.items()}


def differing(a: DataFrame, b: DataFrame) -> list[str]:
    """The columns in which two tables differ as multisets; ``ROWS`` if their rows do, which values that changed places also cause.

    A column that only one table has differs. Types count: 1 and 1.0 have different hashes.
    """
    one, two = fingerprint(a), fingerprint(b)
    return [name for name in sorted(one.keys() | two.keys()) if one.get(name) != two.get(name)]


def compare_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """``column_name``, ``rows_a``, ``rows_b`` and ``same`` for each column of either table, and for the whole rows."""
    one, two = fingerprint(a), fingerprint(b)
    rows = [
        (name, one[ROWS][0], two[ROWS][0], one.get(name) == two.get(name)) for name in sorted(one.keys() | two.keys())
    ]
    return a.sparkSession.createDataFrame(rows, CONTENT)
