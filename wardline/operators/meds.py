"""Prescriptions per admission, per stay and per drug.

Prescriptions are counted per (admission, drug) before anything is joined or
grouped further. An admission or stay with very many prescriptions is down to
one row per drug by then, and lists with repeats become (drug, count) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.parsing import hour_of
from wardline.operators.ordering import collect_segments

ADMISSION = ("subject_id", "hadm_id")


def _hour_bit(hour: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), hour)


def _hours(mask: Column) -> Column:
    """The hours whose bit is set, ascending."""
    day = F.sequence(F.lit(0), F.lit(23))
    return F.filter(day, lambda h: mask.bitwiseAND(_hour_bit(h)) != 0)


def admission_drugs(prescriptions: DataFrame, keys: Sequence[str] = ADMISSION) -> DataFrame:
    """Per admission and drug: prescription count and the start hours as a bit mask."""
    hour = hour_of("starttime", prescriptions.schema["starttime"].dataType)
    return (
        prescriptions.filter(F.col("drug").isNotNull())
        .groupBy(*keys, "drug")
        .agg(
            F.count(F.lit(1)).alias("n_rx"),
            F.coalesce(F.bit_or(_hour_bit(hour)), F.lit(0)).alias("hour_mask"),
        )
    )


def stay_drugs(
    prescriptions: DataFrame, icustays: DataFrame, keys: Sequence[str] = ADMISSION
) -> DataFrame:
    """Per ICU stay and drug: prescription count and hour mask.

    Every stay of an admission gets all prescriptions of that admission, once
    per row of the stays table. Repeated stay rows are counted, not joined one
    by one. The stays table grows with the data, so it is not broadcast: the
    join shuffles on the admission.
    """
    return drugs_of_stays(admission_drugs(prescriptions, keys), admission_stays(icustays, keys), keys)


def admission_stays(icustays: DataFrame, keys: Sequence[str] = ADMISSION) -> DataFrame:
    """Per admission and ICU stay: its rows in the stays table."""
    stays = icustays.filter(F.col("stay_id").isNotNull())
    return stays.groupBy(*keys, "stay_id").agg(F.count(F.lit(1)).alias("n_stay"))


def drugs_of_stays(drugs: DataFrame, stays: DataFrame, keys: Sequence[str] = ADMISSION) -> DataFrame:
    """``stay_drugs`` from ``admission_drugs`` and ``admission_stays``; stored in buckets of the admission, they join without a shuffle."""
    return (
        drugs.join(stays, list(keys))
        .groupBy("stay_id", "drug")
        .agg(
            F.sum(F.col("n_rx") * F.col("n_stay")).alias("n_rx"),
            F.bit_or("hour_mask").alias("hour_mask"),
        )
    )


def medication_summary(drugs: DataFrame) -> DataFrame:
    """Per stay: prescriptions, distinct drugs, and hours of day with a start."""
    return (
        drugs.groupBy("stay_id")
        .agg(
            F.sum("n_rx").alias("total_prescriptions"),
            F.count(F.lit(1)).alias("unique_drugs"),
            F.bit_or("hour_mask").alias("_mask"),
        )
        .withColumn("prescription_hours", _hours(F.col("_mask")))
        .drop("_mask")
    )


def drug_segments(drugs: DataFrame, segment_rows: int = 100_000) -> DataFrame:
    """Each stay's medication list as ``prescribed_drugs`` segments of (drug, n_rx), by name."""
    return collect_segments(
        drugs,
        key="stay_id",
        order_by=["drug"],
        fields=["drug", "n_rx"],
        name="prescribed_drugs",
        segment_rows=segment_rows,
    )


def drug_statistics(
    drugs: DataFrame, min_count: int = 10, min_patients: int = 5
) -> DataFrame:
    """Per drug: prescriptions and stays, for drugs reaching both thresholds.

    ``drugs`` has one row per stay and drug, so counting rows counts stays.
    """
    return (
        drugs.groupBy("drug")
        .agg(
            F.sum("n_rx").alias("drug_count"),
            F.count(F.lit(1)).alias("unique_patients"),
        )
        .filter((F.col("drug_count") >= min_count) & (F.col("unique_patients") >= min_patients))
    )


def top_drugs(statistics: DataFrame, k: int = 50) -> DataFrame:
    return statistics.orderBy(F.desc("drug_count"), "drug").limit(k)
