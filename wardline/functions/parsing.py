"""Casts that give null instead of failing, and null-token handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal number as text. Spark alone would also read "1D", "2f" or "NaN".
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def as_double(column: str) -> Column:
    return F.col(column).try_cast("double")


def as_time(column: str) -> Column:
    """Text or timestamp to an instant; text that is no time gives null."""
    return F.col(column).try_cast("timestamp")


def event_time(chart: str = "charttime", store: str = "storetime") -> Column:
    """The charting time, or the storing time where that is missing."""
    return F.coalesce(as_time(chart), as_time(store))


def hour_of(column: str, data_type: T.DataType) -> Column:
    """Hour of day; a column that already holds times is read without a cast."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.hour(column)
    return F.hour(as_time(column))


def text_number(column: str) -> Column:
    """Double from plain decimal text only, else null."""
    text = F.col(column)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def text_integer(column: str) -> Column:
    """64-bit integer from plain integer text only, else null."""
    text = F.col(column)
    return F.when(text.rlike(INTEGER_PATTERN), F.trim(text).try_cast("bigint"))


def blank_to_null(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def tokens_to_null(column: str, tokens: Iterable[str]) -> Column:
    text = F.col(column)
    return F.when(~text.isin(list(tokens)), text)


def id_text(column: str, data_type: T.DataType) -> Column:
    """An id as text. Ids that became doubles, as one of them was null, lose the ``.0`` again."""
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.col(column).try_cast("bigint").cast("string")
    return F.col(column).cast("string")


def ids_for(data_type: T.DataType, ids: Iterable) -> list:
    """Item ids as literals of the column's own type.

    Casting the ids, not the column, keeps the filter pushable into the scan.
    """
    if isinstance(data_type, T.StringType):
        return [str(i) for i in ids]
    return [int(i) for i in ids]
