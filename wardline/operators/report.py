"""Figures of the analysis report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.operators.features import medication_list, vocabulary
from wardline.schemas import CLINICAL_FEATURES, REPORTED_FLAGS


def flag_distribution(features: DataFrame, flags: tuple[str, ...] = REPORTED_FLAGS) -> DataFrame:
    """Stays per flag and value, all flags in one job."""
    return (
        features.unpivot([], list(flags), "flag", "flag_value")
        .groupBy("flag", "flag_value")
        .agg(F.count(F.lit(1)).alias("stays"))
        .orderBy("flag", "flag_value")
    )


def top_drug_share(
    features: DataFrame, drugs: DataFrame, k: int = 15, size: int = 30, min_stays: int = 5
) -> DataFrame:
    """The first ``k`` vocabulary drugs, the stays that got them, and their share of all stays.

    How many stays' lists contain a drug is what the vocabulary already counted
    as ``stay_count``, so the lists are not searched again.
    """
    total = features.agg(F.count(F.lit(1))).scalar()
    return (
        vocabulary(medication_list(drugs, features), size, min_stays)
        .filter(F.col("position") < k)
        .select(
            "position",
            "drug",
            F.col("stay_count").alias("stays"),
            (F.col("stay_count") / total * 100).alias("percentage"),
        )
    )


def dataset_report(
    dataset: DataFrame, features: DataFrame, vocabulary_size: int
) -> DataFrame:
    """``(section, metric, value)`` rows: overview and multi-label figures.

    ``dataset`` is the joined frame before, ``features`` after feature building.
    """
    rows_in = dataset.agg(F.count(F.lit(1))).scalar()
    stays = F.col("stays")
    figures = features.agg(
        F.count(F.lit(1)).alias("stays"),
        F.avg("total_prescriptions").alias("avg_drugs"),
        F.count_if(F.col("unique_abnormal_types") >= 2).alias("multiple"),
    )
    entries = [
        ("dataset", "icu_stays", stays),
        ("dataset", "clinical_features", F.lit(len(CLINICAL_FEATURES))),
        ("dataset", "drugs_in_model", F.lit(vocabulary_size)),
        ("dataset", "retention_pct", stays / rows_in * 100),
        ("multi_label", "avg_drugs_per_stay", F.col("avg_drugs")),
        ("multi_label", "stays_with_2_types", F.col("multiple")),
        ("multi_label", "stays_with_2_types_pct", F.col("multiple") / stays * 100),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit(metric).alias("metric"),
                value.cast("double").alias("value"),
            )
            for section, metric, value in entries
        ]
    )
    return figures.select(F.inline(rows))


def analysis_report(
    dataset: DataFrame,
    features: DataFrame,
    drugs: DataFrame,
    vocabulary_size: int,
    k: int = 15,
    min_stays: int = 5,
) -> DataFrame:
    """All figures as ``(section, metric, value)``: flags, top drugs, overview, multi-label."""
    flags = flag_distribution(features).select(
        F.lit("flags").alias("section"),
        F.concat_ws("=", "flag", F.col("flag_value").cast("string")).alias("metric"),
        F.col("stays").cast("double").alias("value"),
    )
    top = top_drug_share(features, drugs, k, min_stays=min_stays).select(
        F.lit("top_drugs").alias("section"),
        F.col("drug").alias("metric"),
        F.col("stays").cast("double").alias("value"),
    )
    return flags.union(top).union(dataset_report(dataset, features, vocabulary_size))


def schema_report(features: DataFrame) -> DataFrame:
    """Column names and types of the feature table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(features.schema.fields)]
    return features.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string"
    )


def sample_rows(
    features: DataFrame, drugs: DataFrame, k: int = 10, shown_drugs: int = 3
) -> DataFrame:
    """The first ``k`` stays with the start of their sorted medication list.

    The stays are picked first. A list entry is repeated as often as it was
    prescribed, so the first ``shown_drugs`` names decide what is shown and no
    more than these are gathered per stay.
    """
    shown = features.orderBy("stay_id").limit(k)
    by_name = Window.partitionBy("stay_id").orderBy("drug")
    repeats = F.least(F.col("n_rx"), F.lit(shown_drugs)).cast("int")
    lists = (
        drugs.join(F.broadcast(shown.select("stay_id")), "stay_id", "left_semi")
        .withColumn("_nth", F.row_number().over(by_name))
        .filter(F.col("_nth") <= shown_drugs)
        .groupBy("stay_id")
        .agg(F.array_sort(F.collect_list(F.struct("drug", repeats.alias("n")))).alias("_d"))
        .select(
            "stay_id",
            F.slice(
                F.flatten(F.transform("_d", lambda d: F.array_repeat(d["drug"], d["n"]))),
                1,
                shown_drugs,
            ).alias("sample_drugs"),
        )
    )
    return shown.join(lists, "stay_id").orderBy("stay_id")
