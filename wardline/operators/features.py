"""Feature table, medication vocabulary and ML vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.schemas import CLINICAL_FEATURES, VITAL_BANDS

FLAGS = tuple(b.flag for b in VITAL_BANDS)


def stay_features(summary: DataFrame, meds: DataFrame) -> DataFrame:
    """Stays with both abnormal readings and medication, with all clinical features.

    Both sides have one row per stay. A flag of a vital that is not monitored is 0.
    """
    joined = summary.join(meds, "stay_id")
    missing = {f: F.lit(0) for f in FLAGS if f not in summary.columns}
    joined = joined.withColumns(missing) if missing else joined
    either = (F.col("bp_sys_abnormal") == 1) | (F.col("bp_dia_abnormal") == 1)
    return joined.withColumns(
        {
            "bp_abnormal": either.cast("int"),
            "abnormal_count_ratio": F.col("total_abnormal_count") / F.col("unique_abnormal_types"),
        }
    )


def medication_list(drugs: DataFrame, stays: DataFrame) -> DataFrame:
    """(stay, drug, count) rows of the given stays. A stay without drugs has no rows."""
    return drugs.filter(F.col("drug").isNotNull()).join(
        stays.select("stay_id"), "stay_id", "left_semi"
    )


def term_frequencies(drugs: DataFrame) -> DataFrame:
    """Per drug: corpus count and number of stays it occurs in."""
    return drugs.groupBy("drug").agg(
        F.sum("n_rx").alias("term_count"), F.count(F.lit(1)).alias("stay_count")
    )


def vocabulary(drugs: DataFrame, size: int = 30, min_stays: int = 5) -> DataFrame:
    """The ``size`` most frequent drugs found in at least ``min_stays`` stays.

    ``position`` counts from 0; ties go by name.
    """
    top = (
        term_frequencies(drugs)
        .filter(F.col("stay_count") >= min_stays)
        .orderBy(F.desc("term_count"), "drug")
        .limit(size)
    )
    # At most ``size`` rows: the rank is the number of rows ahead.
    rank = F.row_number().over(Window.orderBy(F.desc("term_count"), "drug")) - 1
    return top.select(rank.alias("position"), "drug", "term_count", "stay_count")


def vocabulary_terms(vocab: DataFrame) -> list[str]:
    """The vocabulary on the driver; its size is the vocabulary limit."""
    return [r["drug"] for r in vocab.orderBy("position").select("drug").collect()]


def drug_count_columns(terms: list[str]) -> list[str]:
    return [f"drug_{i}" for i in range(len(terms))]


def drug_counts(drugs: DataFrame, terms: list[str]) -> DataFrame:
    """Per stay with a vocabulary drug, one count column per term, in one aggregation over these drugs' rows."""
    if not terms:
        raise ValueError("the vocabulary is empty: no drug reached the least number of stays")
    wanted = [
        F.sum(F.when(F.col("drug") == term, F.col("n_rx")).otherwise(0)).alias(name)
        for term, name in zip(terms, drug_count_columns(terms))
    ]
    return drugs.filter(F.col("drug").isin(terms)).groupBy("stay_id").agg(*wanted)


def feature_pipeline(terms: list[str]) -> Pipeline:
    """Assembles ``clinical_features`` and the multi-label ``drug_features``."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(CLINICAL_FEATURES), outputCol="clinical_features"),
            VectorAssembler(inputCols=drug_count_columns(terms), outputCol="drug_features"),
        ]
    )


def vectorize(features: DataFrame, drugs: DataFrame, terms: list[str]) -> DataFrame:
    """Features with both vectors; the per-term helper columns are dropped again."""
    counts = drug_counts(drugs, terms)
    wide = features.join(counts, "stay_id", "left").fillna(0, drug_count_columns(terms))
    model = feature_pipeline(terms).fit(wide)
    return model.transform(wide).drop(*drug_count_columns(terms))


def vector_entries(vectors: DataFrame, *columns: str) -> DataFrame:
    """One row per stay, vector column and position, in one pass."""
    named = [
        F.struct(F.lit(c).alias("vector"), vector_to_array(c).alias("entries")) for c in columns
    ]
    return vectors.select("stay_id", F.inline(F.array(*named))).select(
        "vector", "stay_id", F.posexplode("entries").alias("position", "value")
    )
