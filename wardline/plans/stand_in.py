"""The given test tables in the shape of the clinical tables.

Readings come from ``events`` (stay and subject = user, item = event type),
ICU stays from ``orders``, prescriptions from ``lineitem`` and ``part``,
diagnoses from the customer's nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.schemas import VITAL_BANDS, Band, rekey
from wardline.sources.tables import read_table

# Which event type stands for which monitored item; temperature has none.
ITEM_OF_TYPE = {
    "click": 220045,
    "view": 220050,
    "purchase": 220051,
    "error": 220277,
    "signup": 220210,
}
TYPE_OF_ITEM = {item: kind for kind, item in ITEM_OF_TYPE.items()}

# The clinical ranges under event types, and ranges that fit the events' values.
CLINICAL = rekey(VITAL_BANDS, TYPE_OF_ITEM)
FITTED = (
    Band("click", "heart_rate", "hr_abnormal", 1.0, 200.0),
    Band("view", "bp_systolic", "bp_sys_abnormal", 1.5, 180.0),
    Band("purchase", "bp_diastolic", "bp_dia_abnormal", 0.5, 220.0),
    Band("error", "spo2", "spo2_abnormal", 3.0, None),
    Band("signup", "respiratory_rate", "rr_abnormal", 1.0, 200.0),
)
# Event values stay below 1000; a lower gate lets the outlier filter act.
GATE = (0.0, 400.0)
KEYS = ("hadm_id",)


def _lookup(pairs: dict, key: str) -> Column:
    entries = [F.lit(x) for pair in pairs.items() for x in pair]
    return F.create_map(*entries)[F.col(key)]


def charts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select(
        F.col("user_id").alias("subject_id"),
        F.col("user_id").alias("stay_id"),
        F.col("event_type").alias("itemid"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("valuenum"),
        F.col("ts").alias("charttime"),
        F.col("ts").alias("storetime"),
        "event_id",
    )


def coded_charts(spark: SparkSession, sf: str) -> DataFrame:
    """Readings under the numeric clinical item ids, as messages carry them."""
    return charts(spark, sf).withColumn("itemid", _lookup(ITEM_OF_TYPE, "itemid"))


def served(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of the serving table."""
    names = {b.itemid: b.vital_name for b in CLINICAL}
    return read_table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("subject_id"),
        _lookup(names, "event_type").alias("vital_name"),
        F.col("value").alias("valuenum"),
        F.col("ts").alias("event_time"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as consumed messages; the event id plays the offset."""
    return read_table(spark, sf, "events").select(
        F.col("ts").alias("time"),
        F.col("ts").alias("message_time"),
        F.col("event_id").alias("offset"),
        F.col("event_type").alias("itemid"),
        "value",
    )


def items(spark: SparkSession) -> DataFrame:
    labels = [(kind, f"label of {kind}") for kind in ITEM_OF_TYPE]
    return spark.createDataFrame(labels, "itemid string, label string")


def icustays(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("stay_id")
    )


def prescriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Ship dates have no time of day, so the line number is added as hours."""
    line = read_table(spark, sf, "lineitem")
    part = read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return line.join(part, "l_partkey").select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("p_name").alias("drug"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("starttime"),
    )


def admission_prescriptions(spark: SparkSession, sf: str) -> DataFrame:
    """Prescriptions under both columns of the admission's key; the subject is the order's customer."""
    orders = read_table(spark, sf, "orders")
    subjects = orders.select(F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id")).distinct()
    return prescriptions(spark, sf).join(subjects, "hadm_id")


def admissions(spark: SparkSession, sf: str) -> DataFrame:
    """ICU stays under both columns of the admission's key."""
    return icustays(spark, sf).withColumn("subject_id", F.col("stay_id"))


def diagnoses(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("c_custkey")
    )
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, "c_custkey").select(
        "hadm_id", F.col("c_nationkey").cast("string").alias("icd_code")
    )


def titles(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("icd_code"), F.col("n_name").alias("title")
    )
