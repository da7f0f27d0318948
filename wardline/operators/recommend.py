"""Which medications go with which diagnoses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline.session import lookup_side


# A code means something only within its version, where the tables say which it is.
CODE_KEY = ("icd_code", "icd_version")


def code_key(*frames: DataFrame) -> list[str]:
    """The columns that make up a diagnosis code, as far as all frames have them."""
    return [c for c in CODE_KEY if all(c in f.columns for f in frames)]


def admission_codes(diagnoses: DataFrame) -> DataFrame:
    """Per admission and code, how often the code was recorded."""
    return (
        diagnoses.filter(F.col("icd_code").isNotNull())
        .groupBy("hadm_id", *code_key(diagnoses))
        .agg(F.count(F.lit(1)).alias("n_dx"))
    )


def admission_medications(prescriptions: DataFrame) -> DataFrame:
    """Per admission and drug, how often the drug was prescribed."""
    return (
        prescriptions.filter(F.col("drug").isNotNull())
        .groupBy("hadm_id", "drug")
        .agg(F.count(F.lit(1)).alias("n_rx"))
    )


def co_occurrence(diagnoses: DataFrame, prescriptions: DataFrame) -> DataFrame:
    """Prescriptions per (diagnosis, drug) over all shared admissions.

    Both sides are counted per admission first and the counts multiplied, so
    repeated codes and drugs of an admission never pair up row by row: an
    admission adds no more rows than distinct (code, drug) results.
    """
    return pair_counts(admission_codes(diagnoses), admission_medications(prescriptions))


def pair_counts(codes: DataFrame, medications: DataFrame) -> DataFrame:
    """``co_occurrence`` from ``admission_codes`` and ``admission_medications``."""
    code = ", ".join(f"d.{c}" for c in code_key(codes))
    return codes.sparkSession.sql(
        f"""
        SELECT {code}, m.drug, SUM(d.n_dx * m.n_rx) AS pair_count
        FROM {{codes}} d JOIN {{medications}} m ON d.hadm_id = m.hadm_id
        GROUP BY {code}, m.drug
        """,
        codes=codes,
        medications=medications,
    )


def recommendations(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent drugs per diagnosis, ranked by count, then name."""
    best = Window.partitionBy(*code_key(pairs)).orderBy(F.desc("pair_count"), "drug")
    return pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def with_titles(coded: DataFrame, titles: DataFrame) -> DataFrame:
    """Adds the title of each diagnosis code; unknown codes keep a null title.

    A code with several titles takes the first by name, so no row is doubled.
    """
    key = code_key(coded, titles)
    one = titles.groupBy(*key).agg(F.min("title").alias("title"))
    return coded.join(lookup_side(one), key, "left")


def top_diagnoses(diagnoses: DataFrame, prescriptions: DataFrame, k: int = 10) -> DataFrame:
    """Diagnoses by number of prescriptions in their admissions."""
    per_admission = (
        prescriptions.filter(F.col("drug").isNotNull())
        .groupBy("hadm_id")
        .agg(F.count(F.lit(1)).alias("n_rx"))
    )
    return (
        admission_codes(diagnoses)
        .join(per_admission, "hadm_id")
        .groupBy(*code_key(diagnoses))
        .agg(F.sum(F.col("n_dx") * F.col("n_rx")).alias("prescriptions"))
        .orderBy(F.desc("prescriptions"), *code_key(diagnoses))
        .limit(k)
    )


def top_medications(prescriptions: DataFrame, k: int = 10) -> DataFrame:
    return (
        prescriptions.filter(F.col("drug").isNotNull())
        .groupBy("drug")
        .agg(F.count(F.lit(1)).alias("prescriptions"))
        .orderBy(F.desc("prescriptions"), "drug")
        .limit(k)
    )


def recommendation_summary(recommended: DataFrame) -> DataFrame:
    """Recommendations, distinct diagnoses and medications, medications per diagnosis."""
    return recommended.agg(
        F.count(F.lit(1)).alias("recommendations"),
        F.count_distinct(F.struct(*code_key(recommended))).alias("diagnoses"),
        F.count_distinct("drug").alias("medications"),
    ).withColumn("avg_per_diagnosis", F.col("recommendations") / F.col("diagnoses"))
