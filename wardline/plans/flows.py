"""The feature flow: readings and prescriptions to vectors and report figures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from wardline.operators import features as ft
from wardline.operators import meds, vitals
from wardline.schemas import VITAL_BANDS, Band
from wardline.session import materialize


@dataclass(frozen=True)
class FeatureTables:
    """``features`` has one row per stay, ``drugs`` one per stay and drug."""

    features: DataFrame
    drugs: DataFrame


def dataset(
    charts: DataFrame,
    drugs: DataFrame,
    bands: tuple[Band, ...] = VITAL_BANDS,
    low: float = 0.0,
    high: float = 1000.0,
) -> DataFrame:
    """Abnormal summary and medication summary of each stay that has both, with features."""
    summary = vitals.abnormal_summary(vitals.abnormal_charts(charts, bands, low, high), bands)
    return ft.stay_features(summary, meds.medication_summary(drugs))


def stay_features(
    charts: DataFrame,
    prescriptions: DataFrame,
    icustays: DataFrame,
    keys: Sequence[str] = meds.ADMISSION,
    bands: tuple[Band, ...] = VITAL_BANDS,
    low: float = 0.0,
    high: float = 1000.0,
) -> DataFrame:
    """The flagship result, as one lazy plan."""
    drugs = meds.stay_drugs(prescriptions, icustays, keys)
    return dataset(charts, drugs, bands, low, high)


def feature_tables(
    charts: DataFrame,
    prescriptions: DataFrame,
    icustays: DataFrame,
    keys: Sequence[str] = meds.ADMISSION,
    bands: tuple[Band, ...] = VITAL_BANDS,
    low: float = 0.0,
    high: float = 1000.0,
) -> FeatureTables:
    """The same result plus the drug rows, both stored once.

    Vocabulary, vectors and report each read them again; the raw tables, far
    larger, are scanned a single time.
    """
    drugs = materialize(meds.stay_drugs(prescriptions, icustays, keys), "stay-drugs")
    features = materialize(dataset(charts, drugs, bands, low, high), "features")
    return FeatureTables(features, drugs)


def terms(tables: FeatureTables, size: int = 30, min_stays: int = 5) -> list[str]:
    """The drugs of the vocabulary; computing it runs a job."""
    listed = ft.medication_list(tables.drugs, tables.features)
    return ft.vocabulary_terms(ft.vocabulary(listed, size, min_stays))


def vectors(tables: FeatureTables, vocabulary: list[str] | None = None) -> DataFrame:
    """Feature rows with ``clinical_features`` and ``drug_features``; the latter over ``terms`` unless given."""
    return ft.vectorize(tables.features, tables.drugs, terms(tables) if vocabulary is None else vocabulary)
