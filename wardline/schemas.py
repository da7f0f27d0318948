"""Table schemas and the fixed clinical values every operator shares."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Band:
    """Normal range of one vital sign; a ``None`` bound leaves that side open."""

    itemid: int | str
    vital_name: str
    flag: str
    low: float | None
    high: float | None


# Monitored items, their names, flag columns and normal ranges.
# A reading is abnormal strictly below ``low`` or strictly above ``high``.
VITAL_BANDS: tuple[Band, ...] = (
    Band(220045, "heart_rate", "hr_abnormal", 60.0, 100.0),
    Band(220050, "bp_systolic", "bp_sys_abnormal", 90.0, 140.0),
    Band(220051, "bp_diastolic", "bp_dia_abnormal", 60.0, 90.0),
    Band(220277, "spo2", "spo2_abnormal", 90.0, None),
    Band(220210, "respiratory_rate", "rr_abnormal", 12.0, 20.0),
    Band(223762, "temperature_celsius", "temp_abnormal", 36.0, 37.8),
)

# Position of each column in the clinical feature vector.
CLINICAL_FEATURES: tuple[str, ...] = (
    "hr_abnormal",
    "bp_sys_abnormal",
    "bp_dia_abnormal",
    "spo2_abnormal",
    "rr_abnormal",
    "temp_abnormal",
    "bp_abnormal",
    "total_abnormal_count",
    "unique_abnormal_types",
    "abnormal_count_ratio",
)

# Flags whose distribution the report shows.
REPORTED_FLAGS: tuple[str, ...] = (
    "hr_abnormal",
    "bp_abnormal",
    "spo2_abnormal",
    "rr_abnormal",
    "temp_abnormal",
)

# Dashboard captions; any other vital keeps its own name.
TREND_LABELS: dict[str, str] = {
    "heart_rate": "Heart Rate (bpm)",
    "bp_systolic": "Systolic BP (mmHg)",
    "respiratory_rate": "Respiratory Rate (bpm)",
    "spo2": "SpO2 (%)",
}

# Items shown as last-value panels and as the waveform panel.
PANEL_ITEMS: tuple[str, ...] = ("220045", "220050", "220051", "220277", "223762")
WAVEFORM_ITEM = "220210"

# Fixed value: the one alert threshold all panels share.
ALERT_THRESHOLD = 80.0

# Texts a CSV reader takes for null, then those the later
# normalisation step takes for null.
CSV_NULL_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
TEXT_NULL_TOKENS: tuple[str, ...] = (
    "nan", "None", "NULL", "null", "N/A", "n/a", "", " ",
)

# Column names and order of the clinical tables, of a message and
# of the serving table.
CHARTEVENTS = T.StructType(
    [
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("stay_id", T.LongType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("valuenum", T.StringType()),
        T.StructField("valueuom", T.StringType()),
        T.StructField("charttime", T.StringType()),
        T.StructField("storetime", T.StringType()),
    ]
)
D_ITEMS = T.StructType(
    [
        T.StructField("itemid", T.LongType()),
        T.StructField("label", T.StringType()),
    ]
)
PRESCRIPTIONS = T.StructType(
    [
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("drug", T.StringType()),
        T.StructField("starttime", T.StringType()),
    ]
)
ICUSTAYS = T.StructType(
    [
        T.StructField("subject_id", T.LongType()),
        T.StructField("hadm_id", T.LongType()),
        T.StructField("stay_id", T.LongType()),
    ]
)
DIAGNOSES = T.StructType(
    [
        T.StructField("hadm_id", T.LongType()),
        T.StructField("icd_code", T.StringType()),
    ]
)
VITAL_MAP = T.StructType(
    [
        T.StructField("itemid", T.StringType(), False),
        T.StructField("vital_name", T.StringType(), False),
    ]
)

# A message as it travels: everything is text until it has been checked.
MESSAGE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "subject_id", "hadm_id", "itemid", "vital_name", "value",
            "valuenum", "valueuom", "charttime", "storetime", "event_time",
        )
    ]
)
# The serving table, without the surrogate id the database hands out.
SERVING = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("subject_id", T.StringType()),
        T.StructField("hadm_id", T.StringType()),
        T.StructField("itemid", T.StringType()),
        T.StructField("vital_name", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("valuenum", T.DoubleType()),
        T.StructField("valueuom", T.StringType()),
        T.StructField("charttime", T.TimestampType()),
        T.StructField("storetime", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


def rekey(bands: tuple[Band, ...], ids: dict) -> tuple[Band, ...]:
    """The same bands under other item ids; bands without a new id drop out."""
    return tuple(replace(b, itemid=ids[b.itemid]) for b in bands if b.itemid in ids)
