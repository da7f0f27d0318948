"""Vital-sign readings: gate, classify, summarise per stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.banding import abnormal_flag
from wardline.functions.parsing import as_double, ids_for
from wardline.operators.ordering import collect_segments
from wardline.schemas import VITAL_BANDS, Band
from wardline.session import lookup_side


def name_items(charts: DataFrame, items: DataFrame) -> DataFrame:
    """Readings with the descriptive columns of their item; unknown items stay."""
    return charts.join(lookup_side(items), "itemid", "left")


def gate_vitals(
    charts: DataFrame,
    bands: tuple[Band, ...] = VITAL_BANDS,
    low: float = 0.0,
    high: float = 1000.0,
) -> DataFrame:
    """Monitored items with a stay and a number strictly between ``low`` and ``high``."""
    ids = ids_for(charts.schema["itemid"].dataType, [b.itemid for b in bands])
    return (
        charts.filter(F.col("itemid").isin(ids))
        .filter(F.col("stay_id").isNotNull() & F.col("valuenum").isNotNull())
        .withColumn("valuenum_double", as_double("valuenum"))
        .filter((F.col("valuenum_double") > low) & (F.col("valuenum_double") < high))
    )


def classify(gated: DataFrame, bands: tuple[Band, ...] = VITAL_BANDS) -> DataFrame:
    ids = ids_for(gated.schema["itemid"].dataType, [b.itemid for b in bands])
    flag = abnormal_flag(F.col("itemid"), F.col("valuenum_double"), bands, ids)
    return gated.withColumn("is_abnormal", flag)


def abnormal_charts(
    charts: DataFrame,
    bands: tuple[Band, ...] = VITAL_BANDS,
    low: float = 0.0,
    high: float = 1000.0,
) -> DataFrame:
    """Gated readings with ``valuenum_double`` and ``is_abnormal``."""
    return classify(gate_vitals(charts, bands, low, high), bands)


def abnormal_summary(classified: DataFrame, bands: tuple[Band, ...] = VITAL_BANDS) -> DataFrame:
    """Per stay: flag per vital, counts, and mean, lowest and highest abnormal value.

    The distinct item count is the sum of the flags, so one hash aggregation
    with map-side combine gives everything: each map task sends one row per
    stay, however many readings a stay has. Values of different vitals are
    averaged together, as the summary is defined.
    """
    ids = ids_for(classified.schema["itemid"].dataType, [b.itemid for b in bands])
    flags = [
        F.max(F.when(F.col("itemid") == F.lit(i), 1).otherwise(0)).alias(b.flag)
        for i, b in zip(ids, bands)
    ]
    types = sum((F.col(b.flag) for b in bands), F.lit(0)).cast("long")
    return (
        classified.filter(F.col("is_abnormal") == 1)
        .groupBy("stay_id")
        .agg(
            F.count("itemid").alias("total_abnormal_count"),
            F.avg("valuenum_double").alias("avg_abnormal_value"),
            F.min("valuenum_double").alias("min_abnormal_value"),
            F.max("valuenum_double").alias("max_abnormal_value"),
            *flags,
        )
        .withColumn("unique_abnormal_types", types)
    )


def abnormal_signals(classified: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The abnormal readings of every stay, one row each."""
    return classified.filter(F.col("is_abnormal") == 1).select(
        "stay_id", "itemid", "valuenum_double", "charttime", *extra
    )


def signal_segments(
    classified: DataFrame, row_id: str | None = None, segment_rows: int = 100_000
) -> DataFrame:
    """The abnormal readings of every stay as time-ordered ``abnormal_signals`` lists.

    Readings of one time follow ``row_id`` if given, then their place in the
    scanned files, which also lets many copies of one reading spread over
    partitions. So ``classified`` should come from a scan without a shuffle in
    between; else call :func:`collect_segments` with a unique order.
    """
    ties = ["_row"] if row_id is None else [row_id, "_row"]
    placed = classified.withColumn("_row", F.monotonically_increasing_id())
    return collect_segments(
        abnormal_signals(placed, tuple(ties)),
        key="stay_id",
        order_by=["charttime", *ties],
        fields=["itemid", "valuenum_double", "charttime"],
        name="abnormal_signals",
        segment_rows=segment_rows,
    )
