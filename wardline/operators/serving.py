"""Queries behind the monitoring dashboard, over the serving table.

Times relative to now take ``as_of``, so that a result can be repeated.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.banding import alert_colour, caption
from wardline.functions.parsing import ids_for
from wardline.schemas import ALERT_THRESHOLD, PANEL_ITEMS, TREND_LABELS, WAVEFORM_ITEM


def newest_time(df: DataFrame, column: str = "event_time") -> Column:
    """The latest time in ``df`` as a scalar subquery, for use as ``as_of``."""
    return df.agg(F.max(column)).scalar()


def _instant(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def store_served(served: DataFrame, path: str, mode: str = "append") -> None:
    """Write serving rows by day, clustered by patient and time.

    Range partitioning on all three columns lets a day or patient with very
    many rows fill several files, each covering a narrow range.
    """
    cluster = ["event_date", "subject_id", "event_time"]
    (
        served.withColumn("event_date", F.to_date("event_time"))
        .repartitionByRange(*cluster)
        .sortWithinPartitions(*cluster)
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def trailing(
    df: DataFrame,
    span: str,
    as_of: datetime | Column | None = None,
    column: str = "event_time",
) -> DataFrame:
    """Rows not older than ``span`` (such as ``24 hours``) before ``as_of``.

    A table stored by day is read from the first day of the span on.
    """
    start = _instant(as_of) - F.expr(f"INTERVAL {span}")
    recent = df.filter(F.col(column) >= start)
    if column == "event_time" and "event_date" in df.columns:
        recent = recent.filter(F.col("event_date") >= F.to_date(start))
    return recent


def between(
    df: DataFrame,
    span: str,
    as_of: datetime | Column | None = None,
    column: str = "event_time",
) -> DataFrame:
    """Dashboard range: from ``span`` before ``as_of`` up to ``as_of``, both included."""
    return trailing(df, span, as_of, column).filter(F.col(column) <= _instant(as_of))


def vital_trend(
    served: DataFrame,
    subject_id: str | Column | None = None,
    span: str = "24 hours",
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Captioned series of the trend vitals, of one patient or of all.

    Sorted by time, then by the other columns, so that many readings of one
    time do not end up in one sort partition.
    """
    recent = trailing(served, span, as_of).filter(F.col("vital_name").isin(list(TREND_LABELS)))
    if subject_id is not None:
        recent = recent.filter(F.col("subject_id") == subject_id)
    return recent.select(
        "subject_id",
        F.col("event_time").alias("time"),
        F.col("valuenum").alias("value"),
        caption(F.col("vital_name")).alias("metric"),
    ).orderBy("time", "subject_id", "metric", "value")


def patient_list(served: DataFrame) -> DataFrame:
    return served.select("subject_id").distinct().orderBy("subject_id")


ARRIVAL = ("message_time", "partition", "offset")


def arrival(messages: DataFrame, order_by: tuple[str, ...] = ARRIVAL) -> list[str]:
    """The columns of the order of arrival that the messages have. Offsets count within a partition."""
    return [c for c in order_by if c in messages.columns]


def last_messages(
    messages: DataFrame, order_by: tuple[str, ...] = ARRIVAL, n: int = 100
) -> DataFrame:
    """The ``n`` messages that arrived last, newest first."""
    return messages.orderBy(*[F.desc(c) for c in arrival(messages, order_by)]).limit(n)


def item_series(
    messages: DataFrame, items: Iterable[str], extra: tuple[str, ...] = ()
) -> DataFrame:
    """``time, itemid, value`` of the given items, the value as a number."""
    ids = ids_for(messages.schema["itemid"].dataType, items)
    return messages.filter(F.col("itemid").isin(ids)).select(
        "time", "itemid", F.col("value").try_cast("double").alias("value"), *extra
    )


def waveform(messages: DataFrame, item: str = WAVEFORM_ITEM) -> DataFrame:
    """The waveform panel: one item's series in time order."""
    return item_series(messages, [item]).orderBy("time")


def latest_values(
    messages: DataFrame,
    items: Iterable[str] = PANEL_ITEMS,
    order_by: tuple[str, ...] = ARRIVAL,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Last non-null value per item by arrival over all messages, with its alert colour.

    The newest arrival time per item comes first; it has one row per listed
    item and is broadcast back. That keeps the large step in hash aggregation,
    where ordering by the whole arrival at once would sort the whole input.
    """
    time, *rest = arrival(messages, order_by)
    values = item_series(messages, items, (time, *rest)).filter(F.col("value").isNotNull())
    newest = values.groupBy("itemid").agg(F.max(time).alias(time))
    return (
        values.join(F.broadcast(newest), ["itemid", time])
        .groupBy("itemid")
        .agg(F.max_by("value", F.struct(*rest)).alias("value"))
        .withColumn("colour", alert_colour(F.col("value"), threshold))
    )


def panel_values(
    messages: DataFrame,
    items: Iterable[str] = PANEL_ITEMS,
    n: int = 100,
    order_by: tuple[str, ...] = ARRIVAL,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Last non-null value per item among the ``n`` messages that arrived last."""
    order = arrival(messages, order_by)
    return (
        item_series(last_messages(messages, order, n), items, order)
        .filter(F.col("value").isNotNull())
        .groupBy("itemid")
        .agg(F.max_by("value", F.struct(*order)).alias("value"))
        .withColumn("colour", alert_colour(F.col("value"), threshold))
    )
