"""Registered queries, each with the SQL that has to give the same rows.

Times leave as microseconds since the epoch, lists as rows or joined text, so
that both engines return the same types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import StreamConfig
from wardline.functions.banding import alert_colour
from wardline.functions.messages import decode, encode
from wardline.functions.parsing import event_time
from wardline.operators import features as ft
from wardline.operators import fingerprint, meds, quality, recommend, report, sampling, serving, vitals
from wardline.plans import flows, stand_in
from wardline.operators.ordering import dense_sequence
from wardline.session import scratch_path
from wardline.sources import csv_split, tail
from wardline.sources.bucketed import store_bucketed
from wardline.sources.csv_ingest import ingest_tables
from wardline.sources.messages import message_writer, read_messages
from wardline.sources.tables import read_table
from wardline.streaming import ingest, replay, views
from wardline.streaming.compaction import CompactedTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}



def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


# --- quality -----------------------------------------------------------------

_PROFILED = {
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "orders": [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    ],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate",
    ],
}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, "
        f"COUNT(*) - COUNT({c}) AS null_count, (COUNT(*) - COUNT({c})) / COUNT(*) AS null_rate FROM {t}"
        for t, columns in _PROFILED.items()
        for c in columns
    )
)
def quality_profile(spark, sf):
    profiles = [
        quality.null_profile(read_table(spark, sf, t), t, columns)
        for t, columns in _PROFILED.items()
    ]
    return profiles[0].union(profiles[1]).union(profiles[2])


@query(
    """
    SELECT 'lineitem-orders' AS relation, COUNT(*) AS child_rows,
           COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS orphan_rows,
           COUNT(DISTINCT l_orderkey) FILTER (WHERE o_orderkey IS NULL) AS orphan_keys
    FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders) ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 'orders-events', COUNT(*), COUNT(*) FILTER (WHERE user_id IS NULL),
           COUNT(DISTINCT o_custkey) FILTER (WHERE user_id IS NULL)
    FROM orders LEFT JOIN (SELECT DISTINCT user_id FROM events) ON o_custkey = user_id
    """
)
def relationship_check(spark, sf):
    line, orders, events = (read_table(spark, sf, t) for t in ("lineitem", "orders", "events"))
    return quality.orphan_report(
        line, orders, "l_orderkey", "o_orderkey", "lineitem-orders"
    ).union(quality.orphan_report(orders, events, "o_custkey", "user_id", "orders-events"))


# --- vital signs -------------------------------------------------------------


@query(
    """
    SELECT event_id, user_id AS stay_id, event_type AS itemid,
           'label of ' || event_type AS label, value AS valuenum_double,
           CASE WHEN event_type = 'click' AND (value < 60 OR value > 100) THEN 1
                WHEN event_type = 'view' AND (value < 90 OR value > 140) THEN 1
                WHEN event_type = 'purchase' AND (value < 60 OR value > 90) THEN 1
                WHEN event_type = 'error' AND value < 90 THEN 1
                WHEN event_type = 'signup' AND (value < 12 OR value > 20) THEN 1
                ELSE 0 END AS is_abnormal
    FROM events
    WHERE event_type IN ('click', 'view', 'purchase', 'error', 'signup')
      AND user_id IS NOT NULL AND value IS NOT NULL AND value > 0 AND value < 400
    """
)
def vitals_abnormal(spark, sf):
    named = vitals.name_items(stand_in.charts(spark, sf), stand_in.items(spark))
    return vitals.abnormal_charts(named, stand_in.CLINICAL, *stand_in.GATE).select(
        "event_id", "stay_id", "itemid", "label", "valuenum_double", "is_abnormal"
    )


_ABNORMAL = """
    abnormal AS (
        SELECT event_id, ts, user_id AS stay_id, event_type AS itemid, value AS v
        FROM events
        WHERE user_id IS NOT NULL AND value > 0 AND value < 400
          AND CASE event_type WHEN 'click' THEN value < 1.0 OR value > 200.0
                              WHEN 'view' THEN value < 1.5 OR value > 180.0
                              WHEN 'purchase' THEN value < 0.5 OR value > 220.0
                              WHEN 'error' THEN value < 3.0
                              WHEN 'signup' THEN value < 1.0 OR value > 200.0
                              ELSE FALSE END
    )"""
_SUMMARY = """
    summary AS (
        SELECT stay_id, COUNT(itemid) AS total_abnormal_count,
               COUNT(DISTINCT itemid) AS unique_abnormal_types,
               ROUND(AVG(v), 8) AS avg_abnormal_value,
               MIN(v) AS min_abnormal_value, MAX(v) AS max_abnormal_value,
               CAST(MAX(CASE WHEN itemid = 'click' THEN 1 ELSE 0 END) AS INTEGER) AS hr_abnormal,
               CAST(MAX(CASE WHEN itemid = 'view' THEN 1 ELSE 0 END) AS INTEGER) AS bp_sys_abnormal,
               CAST(MAX(CASE WHEN itemid = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS bp_dia_abnormal,
               CAST(MAX(CASE WHEN itemid = 'error' THEN 1 ELSE 0 END) AS INTEGER) AS spo2_abnormal,
               CAST(MAX(CASE WHEN itemid = 'signup' THEN 1 ELSE 0 END) AS INTEGER) AS rr_abnormal
        FROM abnormal GROUP BY stay_id
    )"""


def _fitted(spark, sf):
    return vitals.abnormal_charts(stand_in.charts(spark, sf), stand_in.FITTED, *stand_in.GATE)


def _rounded_mean(df):
    return df.withColumn("avg_abnormal_value", F.round("avg_abnormal_value", 8))


@query(f"WITH {_ABNORMAL}, {_SUMMARY} SELECT * FROM summary")
def abnormal_summary(spark, sf):
    return _rounded_mean(vitals.abnormal_summary(_fitted(spark, sf), stand_in.FITTED))


@query(
    f"""WITH {_ABNORMAL}
    SELECT stay_id, itemid, v AS valuenum_double, epoch_us(ts) AS charttime_us FROM abnormal"""
)
def abnormal_signals(spark, sf):
    return (
        vitals.abnormal_signals(_fitted(spark, sf))
        .withColumn("charttime_us", micros("charttime"))
        .drop("charttime")
    )


@query(
    f"""WITH {_ABNORMAL},
    placed AS (
        SELECT *, (ROW_NUMBER() OVER (ORDER BY stay_id, ts, event_id) - 1) // 50 AS segment
        FROM abnormal)
    SELECT stay_id, CAST(segment AS BIGINT) AS segment, CAST(COUNT(*) AS INTEGER) AS entries,
           STRING_AGG(itemid, ',' ORDER BY ts, event_id) AS items,
           epoch_us(MIN(ts)) AS first_us, MAX(v) AS max_value
    FROM placed GROUP BY stay_id, segment"""
)
def signal_segments(spark, sf):
    signals = F.col("abnormal_signals")
    return vitals.signal_segments(_fitted(spark, sf), "event_id", segment_rows=50).select(
        "stay_id",
        "segment",
        F.size(signals).alias("entries"),
        F.array_join(signals["itemid"], ",").alias("items"),
        F.unix_micros(signals[0]["charttime"].cast("timestamp")).alias("first_us"),
        F.array_max(signals["valuenum_double"]).alias("max_value"),
    )


# --- medication --------------------------------------------------------------

_DRUGS = """
    rx AS (
        SELECT o_custkey AS stay_id, o_orderkey AS hadm_id, p_name AS drug,
               EXTRACT(HOUR FROM l_shipdate + l_linenumber * INTERVAL 1 HOUR) AS h
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        WHERE p_name IS NOT NULL AND o_custkey IS NOT NULL
    ),
    drugs AS (SELECT stay_id, drug, COUNT(*) AS n_rx FROM rx GROUP BY stay_id, drug)"""
_MEDS = """
    meds AS (
        SELECT stay_id, COUNT(drug) AS total_prescriptions, COUNT(DISTINCT drug) AS unique_drugs,
               STRING_AGG(DISTINCT CAST(h AS VARCHAR), ',' ORDER BY CAST(h AS VARCHAR)) AS prescription_hours
        FROM rx GROUP BY stay_id
    )"""


def _drugs(spark, sf):
    return meds.stay_drugs(
        stand_in.prescriptions(spark, sf), stand_in.icustays(spark, sf), stand_in.KEYS
    )


def _hours_as_text(df):
    hours = F.array_sort(F.transform("prescription_hours", lambda h: h.cast("string")))
    return df.withColumn("prescription_hours", F.array_join(hours, ","))


@query(f"WITH {_DRUGS} SELECT stay_id, drug, n_rx FROM drugs")
def prescribed_drugs(spark, sf):
    return _drugs(spark, sf).select("stay_id", "drug", "n_rx")


@query(
    f"""WITH {_DRUGS},
    placed AS (
        SELECT *, (ROW_NUMBER() OVER (ORDER BY stay_id, drug) - 1) // 100 AS segment FROM drugs)
    SELECT stay_id, CAST(segment AS BIGINT) AS segment,
           STRING_AGG(drug || ':' || n_rx, ',' ORDER BY drug) AS drugs
    FROM placed GROUP BY stay_id, segment"""
)
def drug_segments(spark, sf):
    entry = F.transform(
        "prescribed_drugs", lambda d: F.concat_ws(":", d["drug"], d["n_rx"].cast("string"))
    )
    return meds.drug_segments(_drugs(spark, sf), segment_rows=100).select(
        "stay_id", "segment", F.array_join(entry, ",").alias("drugs")
    )


@query(f"WITH {_DRUGS}, {_MEDS} SELECT * FROM meds")
def icu_meds(spark, sf):
    return _hours_as_text(meds.medication_summary(_drugs(spark, sf)))


@query(
    f"""WITH {_DRUGS}
    SELECT drug, CAST(SUM(n_rx) AS BIGINT) AS drug_count, COUNT(DISTINCT stay_id) AS unique_patients
    FROM drugs GROUP BY drug HAVING SUM(n_rx) >= 900 AND COUNT(DISTINCT stay_id) >= 650
    ORDER BY drug_count DESC, drug LIMIT 50"""
)
def drug_stats_top50(spark, sf):
    return meds.top_drugs(meds.drug_statistics(_drugs(spark, sf), 900, 650), 50)


# --- features and report -----------------------------------------------------

_FEATURES = f"""{_ABNORMAL}, {_SUMMARY}, {_DRUGS}, {_MEDS},
    features AS (
        SELECT *, CAST(0 AS INTEGER) AS temp_abnormal,
               CAST(CASE WHEN bp_sys_abnormal = 1 OR bp_dia_abnormal = 1 THEN 1 ELSE 0 END AS INTEGER) AS bp_abnormal,
               total_abnormal_count / unique_abnormal_types AS abnormal_count_ratio
        FROM summary JOIN meds USING (stay_id)
    ),
    listed AS (SELECT * FROM drugs WHERE stay_id IN (SELECT stay_id FROM features)),
    vocab AS (
        SELECT ROW_NUMBER() OVER (ORDER BY term_count DESC, drug) - 1 AS position, *
        FROM (SELECT drug, CAST(SUM(n_rx) AS BIGINT) AS term_count, COUNT(*) AS stay_count
              FROM listed GROUP BY drug HAVING COUNT(*) >= 5)
        ORDER BY position LIMIT 30
    )"""


def _features(spark, sf):
    return flows.stay_features(
        stand_in.charts(spark, sf),
        stand_in.prescriptions(spark, sf),
        stand_in.icustays(spark, sf),
        stand_in.KEYS,
        stand_in.FITTED,
        *stand_in.GATE,
    )


def _tables(spark, sf):
    return flows.feature_tables(
        stand_in.charts(spark, sf),
        stand_in.prescriptions(spark, sf),
        stand_in.icustays(spark, sf),
        stand_in.KEYS,
        stand_in.FITTED,
        *stand_in.GATE,
    )


@query(f"WITH {_FEATURES} SELECT * FROM features")
def stay_features(spark, sf):
    return _rounded_mean(_hours_as_text(_features(spark, sf)))


@query(
    f"""WITH {_FEATURES}
    SELECT CAST(position AS INTEGER) AS position, drug, term_count, stay_count FROM vocab"""
)
def drug_vocab_top30(spark, sf):
    tables = _tables(spark, sf)
    return ft.vocabulary(ft.medication_list(tables.drugs, tables.features))


@query(
    f"""WITH {_FEATURES},
    clinical AS (
        SELECT stay_id, UNNEST([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) AS position,
               UNNEST([CAST(hr_abnormal AS DOUBLE), bp_sys_abnormal, bp_dia_abnormal, spo2_abnormal,
                       rr_abnormal, temp_abnormal, bp_abnormal, total_abnormal_count,
                       unique_abnormal_types, abnormal_count_ratio]) AS value
        FROM features
    )
    SELECT 'clinical_features' AS vector, stay_id, CAST(position AS INTEGER) AS position, value FROM clinical
    UNION ALL
    SELECT 'drug_features', f.stay_id, CAST(v.position AS INTEGER), CAST(COALESCE(l.n_rx, 0) AS DOUBLE)
    FROM features f CROSS JOIN vocab v LEFT JOIN listed l ON l.stay_id = f.stay_id AND l.drug = v.drug"""
)
def feature_vectors(spark, sf):
    vectors = flows.vectors(_tables(spark, sf))
    return ft.vector_entries(vectors, "clinical_features", "drug_features")


@query(
    f"""WITH {_FEATURES}
    SELECT CAST(position AS INTEGER) AS position, drug, stay_count AS stays,
           ROUND(stay_count / (SELECT COUNT(*) FROM features) * 100, 6) AS percentage
    FROM vocab WHERE position < 15"""
)
def top_drugs_pct(spark, sf):
    tables = _tables(spark, sf)
    return report.top_drug_share(tables.features, tables.drugs).withColumn(
        "percentage", F.round("percentage", 6)
    )


_REPORT = """
    n AS (SELECT CAST(COUNT(*) AS DOUBLE) AS stays, AVG(total_prescriptions) AS avg_drugs,
                 COUNT(*) FILTER (WHERE unique_abnormal_types >= 2) AS multiple,
                 (SELECT COUNT(*) FROM vocab) AS terms FROM features),
    report AS (
        SELECT 'dataset' AS section, 'icu_stays' AS metric, stays AS value FROM n
        UNION ALL SELECT 'dataset', 'clinical_features', 10 FROM n
        UNION ALL SELECT 'dataset', 'drugs_in_model', terms FROM n
        UNION ALL SELECT 'dataset', 'retention_pct', stays / (SELECT COUNT(*) FROM summary JOIN meds USING (stay_id)) * 100 FROM n
        UNION ALL SELECT 'multi_label', 'avg_drugs_per_stay', ROUND(avg_drugs, 6) FROM n
        UNION ALL SELECT 'multi_label', 'stays_with_2_types', multiple FROM n
        UNION ALL SELECT 'multi_label', 'stays_with_2_types_pct', ROUND(multiple / stays * 100, 6) FROM n
    ),
    flags AS (
        SELECT flag, CAST(flag_value AS INTEGER) AS flag_value, COUNT(*) AS stays
        FROM (UNPIVOT (SELECT hr_abnormal, bp_abnormal, spo2_abnormal, rr_abnormal, temp_abnormal FROM features)
              ON hr_abnormal, bp_abnormal, spo2_abnormal, rr_abnormal, temp_abnormal
              INTO NAME flag VALUE flag_value)
        GROUP BY flag, flag_value
    )"""


@query(f"WITH {_FEATURES}, {_REPORT} SELECT flag, flag_value, stays FROM flags")
def flag_distribution(spark, sf):
    return report.flag_distribution(_features(spark, sf))


@query(f"WITH {_FEATURES}, {_REPORT} SELECT * FROM report")
def dataset_report(spark, sf):
    tables = _tables(spark, sf)
    vocabulary = flows.terms(tables)
    return report.dataset_report(
        tables.features, flows.vectors(tables, vocabulary), len(vocabulary)
    ).withColumn("value", F.round("value", 6))


@query(
    f"""WITH {_FEATURES}, {_REPORT}
    SELECT * FROM report
    UNION ALL SELECT 'flags', flag || '=' || flag_value, CAST(stays AS DOUBLE) FROM flags
    UNION ALL SELECT 'top_drugs', drug, CAST(stay_count AS DOUBLE) FROM vocab WHERE position < 15"""
)
def analysis_report(spark, sf):
    tables = _tables(spark, sf)
    return report.analysis_report(
        tables.features, tables.features, tables.drugs, len(flows.terms(tables))
    ).withColumn("value", F.round("value", 6))


@query(
    f"""WITH {_FEATURES},
    shown AS (SELECT * FROM features ORDER BY stay_id LIMIT 10),
    ranked AS (
        SELECT stay_id, drug, ROW_NUMBER() OVER (PARTITION BY stay_id ORDER BY drug) AS r
        FROM rx WHERE stay_id IN (SELECT stay_id FROM shown)
    )
    SELECT stay_id, total_abnormal_count, unique_abnormal_types, abnormal_count_ratio,
           (SELECT STRING_AGG(drug, ',' ORDER BY r) FROM ranked
            WHERE ranked.stay_id = shown.stay_id AND r <= 3) AS sample_drugs
    FROM shown"""
)
def sample_rows(spark, sf):
    tables = _tables(spark, sf)
    return report.sample_rows(tables.features, tables.drugs).select(
        "stay_id",
        "total_abnormal_count",
        "unique_abnormal_types",
        "abnormal_count_ratio",
        F.array_join("sample_drugs", ",").alias("sample_drugs"),
    )


# --- recommendation ----------------------------------------------------------

_PAIRS = """
    dx AS (SELECT o_orderkey AS hadm_id, CAST(c_nationkey AS VARCHAR) AS icd_code
           FROM orders JOIN customer ON o_custkey = c_custkey),
    rx AS (SELECT l_orderkey AS hadm_id, p_name AS drug FROM lineitem JOIN part ON l_partkey = p_partkey),
    pairs AS (SELECT icd_code, drug, COUNT(*) AS pair_count
              FROM dx JOIN rx USING (hadm_id) GROUP BY icd_code, drug),
    recommended AS (
        SELECT * FROM (SELECT *, CAST(ROW_NUMBER() OVER (
            PARTITION BY icd_code ORDER BY pair_count DESC, drug) AS INTEGER) AS rank FROM pairs)
        WHERE rank <= 5)"""


def _recommended(spark, sf):
    return recommend.recommendations(
        recommend.co_occurrence(stand_in.diagnoses(spark, sf), stand_in.prescriptions(spark, sf))
    )


@query(
    f"""WITH {_PAIRS}
    SELECT icd_code, n_name AS title, drug, pair_count, rank
    FROM recommended LEFT JOIN nation ON icd_code = CAST(n_nationkey AS VARCHAR)"""
)
def recommend_pairs(spark, sf):
    return recommend.with_titles(_recommended(spark, sf), stand_in.titles(spark, sf))


@query(
    f"""WITH {_PAIRS}
    SELECT COUNT(*) AS recommendations, COUNT(DISTINCT icd_code) AS diagnoses,
           COUNT(DISTINCT drug) AS medications, COUNT(*) / COUNT(DISTINCT icd_code) AS avg_per_diagnosis
    FROM recommended"""
)
def recommend_summary(spark, sf):
    return recommend.recommendation_summary(_recommended(spark, sf))


@query(
    f"""WITH {_PAIRS}
    SELECT icd_code, COUNT(*) AS prescriptions FROM dx JOIN rx USING (hadm_id)
    GROUP BY icd_code ORDER BY prescriptions DESC, icd_code LIMIT 10"""
)
def top_diagnoses(spark, sf):
    return recommend.top_diagnoses(
        stand_in.diagnoses(spark, sf), stand_in.prescriptions(spark, sf)
    )


@query(
    """
    SELECT p_name AS drug, COUNT(*) AS prescriptions FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_name ORDER BY prescriptions DESC, drug LIMIT 10"""
)
def top_medications(spark, sf):
    return recommend.top_medications(stand_in.prescriptions(spark, sf))


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE CAST('0x' || SUBSTR(MD5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 0"""
)
def sample_tenth(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.sample_keys(orders, "o_orderkey")


@query(
    """
    SELECT user_id, event_type, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour, event_id, value
    FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type, EXTRACT(HOUR FROM ts) ORDER BY event_id) = 1"""
)
def dedup_keys(spark, sf):
    events = read_table(spark, sf, "events").select(
        "user_id", "event_type", F.hour("ts").alias("hour"), "event_id", "value"
    )
    return sampling.drop_duplicates_first(events, ["user_id", "event_type", "hour"], "event_id")


# --- serving -----------------------------------------------------------------


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS subject_id FROM events")
def patient_list(spark, sf):
    return serving.patient_list(stand_in.served(spark, sf))


_TREND = """
    SELECT CAST(user_id AS VARCHAR) AS subject_id, epoch_us(ts) AS time_us, value,
           CASE event_type WHEN 'click' THEN 'Heart Rate (bpm)' WHEN 'view' THEN 'Systolic BP (mmHg)'
                           WHEN 'signup' THEN 'Respiratory Rate (bpm)' ELSE 'SpO2 (%)' END AS metric
    FROM events
    WHERE event_type IN ('click', 'view', 'signup', 'error')
      AND ts >= (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR"""


def _trend(served):
    return (
        serving.vital_trend(served, as_of=serving.newest_time(served))
        .withColumn("time_us", micros("time"))
        .drop("time")
    )


@query(_TREND)
def vital_trend_24h(spark, sf):
    return _trend(stand_in.served(spark, sf))


@query(_TREND)
def vital_trend_by_day(spark, sf):
    path = scratch_path(spark, "served-by-day")
    serving.store_served(stand_in.served(spark, sf), path)
    return _trend(spark.read.parquet(path))


@query(
    """
    SELECT event_id, epoch_us(ts) AS time_us, value FROM events
    WHERE ts >= (SELECT MAX(ts) FROM events) - INTERVAL 300 MINUTE
      AND ts <= (SELECT MAX(ts) FROM events)"""
)
def recent_window(spark, sf):
    events = read_table(spark, sf, "events")
    as_of = serving.newest_time(events, "ts")
    return serving.between(events, "300 minutes", as_of, "ts").select(
        "event_id", micros("ts").alias("time_us"), "value"
    )


_LATEST = """
    SELECT event_type AS itemid, ARG_MAX(value, (ts, event_id)) AS value,
           CASE WHEN ARG_MAX(value, (ts, event_id)) >= 80 THEN 'red' ELSE 'green' END AS colour
    FROM {rows}
    WHERE event_type IN ('click', 'view', 'purchase', 'error', 'signup') AND value IS NOT NULL
    GROUP BY event_type"""
_LAST_100 = "(SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)"


@query(_LATEST.format(rows="events"))
def latest_vital(spark, sf):
    return serving.latest_values(stand_in.messages(spark, sf), stand_in.ITEM_OF_TYPE)


@query(_LATEST.format(rows=_LAST_100))
def panel_values(spark, sf):
    return serving.panel_values(stand_in.messages(spark, sf), stand_in.ITEM_OF_TYPE)


@query(
    f"""
    SELECT epoch_us(ts) AS time_us, event_type AS itemid, value FROM {_LAST_100}
    WHERE event_type = 'signup'"""
)
def waveform_panel(spark, sf):
    last = serving.last_messages(stand_in.messages(spark, sf))
    return serving.waveform(last, "signup").select(
        micros("time").alias("time_us"), "itemid", "value"
    )


@query(
    f"""
    SELECT epoch_us(ts) AS time_us, event_id AS "offset", event_type AS itemid, value,
           CASE WHEN value >= 80 THEN 'red' ELSE 'green' END AS colour
    FROM {_LAST_100}"""
)
def last_100_messages(spark, sf):
    return serving.last_messages(stand_in.messages(spark, sf)).select(
        micros("time").alias("time_us"),
        "offset",
        "itemid",
        "value",
        alert_colour(F.col("value")).alias("colour"),
    )


_BATCH_MESSAGES = 1000


@query(
    f"""
    SELECT epoch_us(ts) AS time_us, event_id AS "offset", event_type AS itemid, value FROM {_LAST_100}"""
)
def tail_100_messages(spark, sf):
    """The last messages of a topic stored by micro-batch, from its newest batches alone."""
    topic = scratch_path(spark, "stored-topic")
    arrived = dense_sequence(stand_in.messages(spark, sf), ["message_time", "offset"])
    batch = F.expr(f"seq div {_BATCH_MESSAGES}")
    tail.store_batches(arrived.withColumn("partition", F.lit(0)), topic, batch)
    return tail.last_stored(spark, topic).select(micros("time").alias("time_us"), "offset", "itemid", "value")


# --- replay and ingest -------------------------------------------------------


@query(
    """
    SELECT event_id, epoch_us(event_time) AS event_time_us
    FROM (SELECT event_id,
                 CASE WHEN event_type IN ('purchase', 'error') THEN ts
                      WHEN event_type <> 'signup' THEN ts + INTERVAL 1 HOUR END AS event_time
          FROM events)
    WHERE event_time IS NOT NULL"""
)
def event_time_fallback(spark, sf):
    # Purchases and errors have a charting time. Clicks and views only a storing
    # time, signups none that can be read.
    kind = F.col("event_type")
    charts = read_table(spark, sf, "events").select(
        "event_id",
        F.when(kind.isin("purchase", "error"), F.col("ts").cast("string"))
        .when(kind.isin("view", "signup"), "not a time")
        .alias("charttime"),
        F.when(kind == "signup", "neither")
        .when(kind != "error", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).cast("string"))
        .alias("storetime"),
    )
    return charts.withColumn("event_time", event_time()).filter("event_time IS NOT NULL").select(
        "event_id", micros("event_time").alias("event_time_us")
    )


_CODED = """
    coded AS (
        SELECT *, CASE event_type WHEN 'click' THEN '220045' WHEN 'view' THEN '220050'
                      WHEN 'purchase' THEN '220051' WHEN 'error' THEN '220277' ELSE '220210' END AS itemid,
               CASE event_type WHEN 'click' THEN 'heart_rate' WHEN 'view' THEN 'bp_systolic'
                      WHEN 'purchase' THEN 'bp_diastolic' WHEN 'error' THEN 'spo2'
                      ELSE 'respiratory_rate' END AS vital_name
        FROM events
    ),
    history AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ts, itemid, event_id) - 1 AS seq FROM coded)"""


def _history(spark, sf):
    return replay.replay_history(stand_in.coded_charts(spark, sf), row_id="event_id")


@query(
    f"""WITH {_CODED}
    SELECT seq, event_id, itemid, vital_name, epoch_us(ts) AS event_time_us FROM history"""
)
def replay_sequence(spark, sf):
    return _history(spark, sf).select(
        "seq",
        "event_id",
        F.col("itemid_str").alias("itemid"),
        "vital_name",
        micros("event_time").alias("event_time_us"),
    )


_TICKS = """
    ticks AS (SELECT UNNEST(RANGE(0, (SELECT COUNT(*) + COUNT(*) // 2 FROM events))) AS tick),
    replayed AS (SELECT h.* FROM ticks JOIN history h ON tick % (SELECT COUNT(*) FROM events) = h.seq)"""


@query(
    f"""WITH {_CODED}, {_TICKS}
    SELECT seq, event_id, itemid, vital_name, value AS valuenum, epoch_us(ts) AS event_time_us FROM replayed"""
)
def replay_batch(spark, sf):
    history = _history(spark, sf)
    length = history.count()
    ticks = spark.range(length + length // 2).withColumnRenamed("id", "tick")
    return replay.replay(ticks, history, length).select(
        "seq",
        "event_id",
        F.col("itemid_str").alias("itemid"),
        "vital_name",
        "valuenum",
        micros("event_time").alias("event_time_us"),
    )


# Messages carry milliseconds.
_MESSAGE_ROWS = """
    SELECT CAST(user_id AS VARCHAR) AS subject_id, itemid, vital_name, value AS valuenum,
           epoch_us(ts) // 1000 AS event_time_ms
    FROM {rows}"""


def _message_rows(decoded):
    return decoded.select(
        "subject_id",
        "itemid",
        "vital_name",
        "valuenum",
        F.unix_millis("event_time").alias("event_time_ms"),
    )


@query(f"WITH {_CODED}, {_TICKS} {_MESSAGE_ROWS.format(rows='replayed')}")
def replay_stream(spark, sf):
    history = _history(spark, sf)
    length = history.count()
    out = scratch_path(spark, "replayed")
    ticks = replay.clock(
        spark,
        fmt="rate-micro-batch",
        options={"rowsPerBatch": length + length // 2, "startTimestamp": 0},
    )
    messages = replay.replay_messages(ticks, history, length).select("value")
    writer = message_writer(
        messages, StreamConfig(), scratch_path(spark, "replay-checkpoint"), "text", out
    )
    ingest.finish(writer.trigger(availableNow=True).start())
    return _message_rows(decode(spark.read.text(out)))


@query(f"WITH {_CODED} {_MESSAGE_ROWS.format(rows='coded')}")
def json_roundtrip(spark, sf):
    events = replay.name_vitals(replay.with_event_time(stand_in.coded_charts(spark, sf)))
    return _message_rows(decode(encode(events)))


@query(f"WITH {_CODED} {_MESSAGE_ROWS.format(rows='coded')}")
def stream_ingest(spark, sf):
    topic, table = scratch_path(spark, "topic"), scratch_path(spark, "served")
    events = replay.name_vitals(replay.with_event_time(stand_in.coded_charts(spark, sf)))
    encode(events).select("value").write.text(topic)
    arriving = read_messages(
        spark, StreamConfig(), "text", topic, {"maxFilesPerTrigger": "64"}
    )
    loading = ingest.load_messages(
        arriving,
        ingest.parquet_sink(table),
        ingest.parquet_sink(scratch_path(spark, "rejects")),
        scratch_path(spark, "load-checkpoint"),
        {"availableNow": True},
    )
    ingest.finish(loading.start())
    return _message_rows(spark.read.parquet(table))


@query(
    """
    WITH ms AS (SELECT CAST(user_id AS VARCHAR) AS subject_id, epoch_us(ts) // 1000 AS time_ms, value, event_type FROM events),
    busiest AS (SELECT subject_id FROM ms GROUP BY subject_id ORDER BY COUNT(*) DESC, subject_id LIMIT 1)
    SELECT subject_id, time_ms, value,
           CASE event_type WHEN 'click' THEN 'Heart Rate (bpm)' WHEN 'view' THEN 'Systolic BP (mmHg)'
                           WHEN 'signup' THEN 'Respiratory Rate (bpm)' ELSE 'SpO2 (%)' END AS metric
    FROM ms
    WHERE event_type IN ('click', 'view', 'signup', 'error') AND subject_id IN (SELECT subject_id FROM busiest)
      AND time_ms >= (SELECT MAX(time_ms) FROM ms) - 24 * 3600 * 1000"""
)
def loaded_trend_one_patient(spark, sf):
    """Trend of the patient with most readings, over a table loaded from a topic in daily folders."""
    topic, table = scratch_path(spark, "topic"), scratch_path(spark, "served-by-day")
    events = replay.name_vitals(replay.with_event_time(stand_in.coded_charts(spark, sf)))
    encode(events).select("value").write.text(topic)
    loading = ingest.load_messages(
        read_messages(spark, StreamConfig(), "text", topic, most_per_batch=64),
        ingest.day_sink(table),
        ingest.parquet_sink(scratch_path(spark, "rejects")),
        scratch_path(spark, "load-checkpoint"),
        {"availableNow": True},
    )
    ingest.finish(loading.start())
    served = spark.read.parquet(table)
    counts = served.groupBy("subject_id").agg(F.count("*").alias("n"))
    busiest = counts.orderBy(F.desc("n"), "subject_id").limit(1).select("subject_id").scalar()
    trend = serving.vital_trend(served, busiest, as_of=serving.newest_time(served))
    return trend.withColumn("time_ms", F.unix_millis("time")).drop("time")


def _load_topic(spark, sf, sink):
    """Events as a topic of files, loaded a few files a micro-batch."""
    topic = scratch_path(spark, "topic")
    events = replay.name_vitals(replay.with_event_time(stand_in.coded_charts(spark, sf)))
    encode(events).select("value").repartition(8).write.text(topic)
    loading = ingest.load_messages(
        read_messages(spark, StreamConfig(), "text", topic, most_per_batch=2),
        sink,
        ingest.parquet_sink(scratch_path(spark, "rejects")),
        scratch_path(spark, "load-checkpoint"),
        {"availableNow": True},
    )
    ingest.finish(loading.start())


@query(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS patients,
           MIN(epoch_us(ts) // 1000) AS first_ms, MAX(epoch_us(ts) // 1000) AS last_ms
    FROM events GROUP BY 1"""
)
def compacted_days(spark, sf):
    """Days of a loaded table after two compactions; the last micro-batch is still loose."""
    path = scratch_path(spark, "served-by-day")
    _load_topic(spark, sf, ingest.day_sink(path))
    table = CompactedTable(spark, path)
    table.compact(upto=0)
    table.compact()
    table.clean()
    time = F.unix_millis("event_time")
    return table.read().groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("subject_id").alias("patients"),
        F.min(time).alias("first_ms"), F.max(time).alias("last_ms"),
    )


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS subject_id FROM events")
def maintained_patients(spark, sf):
    """The patient list, kept while a topic is loaded."""
    view = scratch_path(spark, "patients")
    table = ingest.day_sink(scratch_path(spark, "served-by-day"))
    _load_topic(spark, sf, views.fan_out(table, views.distinct_sink(view, "subject_id")))
    return views.maintained_patient_list(spark, view)


# Small enough to cut the small tables in many places too.
_CSV_RANGE_BYTES = 64 * 1024


@query(
    """
    SELECT event_id, props || chr(10) || event_type || chr(10) || '"' || user_id || '", ' AS note, value FROM events"""
)
def csv_split_ranges(spark, sf):
    """A plain CSV file with quotes and line breaks in its fields, cut at many borders."""
    path = scratch_path(spark, "plain-csv")
    note = F.concat_ws("\n", "props", "event_type", F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('", ')))
    rows = read_table(spark, sf, "events").select("event_id", note.alias("note"), "value")
    # Spaces at a field's ends stay.
    writer = rows.coalesce(1).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    files = [r["path"] for r in tail.files_of(spark, path).select("path").collect()]
    found = csv_split.records(spark, files, _CSV_RANGE_BYTES)
    parsed = csv_split.read_records(found, rows.schema)
    return parsed.select(F.col("event_id").cast("bigint"), "note", F.col("value").cast("double"))


_CHANGED = """
    changed AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_custkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey - 1 END AS o_custkey FROM orders)"""


@query(
    f"""WITH {_CHANGED},
    answers AS (
        {' UNION ALL '.join(
            f"SELECT '{c}' AS column_name, NOT EXISTS ((SELECT {c} FROM orders EXCEPT ALL SELECT {c} FROM changed)) AS same"
            for c in ("o_orderkey", "o_orderstatus", "o_custkey"))}
        UNION ALL SELECT '(rows)', NOT EXISTS (
            (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders EXCEPT ALL SELECT * FROM changed)))
    SELECT column_name, (SELECT COUNT(*) FROM orders) AS rows_a, (SELECT COUNT(*) FROM changed) AS rows_b, same FROM answers"""
)
def content_check(spark, sf):
    """Orders against a copy with some values changed and others at the wrong rows."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    copy = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 1000 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey") - 1).alias("o_custkey"),
    )
    return fingerprint.compare_content(orders, copy)


@query(
    """
    SELECT o_custkey AS stay_id, drug, COUNT(*) AS n_rx
    FROM (SELECT s.o_custkey AS subject_id, l_orderkey AS hadm_id, p_name AS drug
          FROM lineitem JOIN part ON l_partkey = p_partkey
            JOIN (SELECT DISTINCT o_orderkey, o_custkey FROM orders) s ON l_orderkey = s.o_orderkey)
      JOIN orders ON o_custkey = subject_id AND o_orderkey = hadm_id
    GROUP BY o_custkey, drug"""
)
def bucketed_prescribed_drugs(spark, sf):
    """Drugs of each stay from tables stored in buckets of both columns of the admission; they meet without a shuffle."""
    stored = store_bucketed(
        {
            "drugs": meds.admission_drugs(stand_in.admission_prescriptions(spark, sf)),
            "stays": meds.admission_stays(stand_in.admissions(spark, sf)),
        },
        meds.ADMISSION,
    ).frames
    return meds.drugs_of_stays(stored["drugs"], stored["stays"]).select("stay_id", "drug", "n_rx")


@query(f"WITH {_PAIRS} SELECT icd_code, drug, pair_count FROM pairs")
def bucketed_pairs(spark, sf):
    """How often each drug goes with each diagnosis, from tables stored in buckets of the admission."""
    stored = store_bucketed(
        {
            "codes": recommend.admission_codes(stand_in.diagnoses(spark, sf)),
            "medications": recommend.admission_medications(stand_in.prescriptions(spark, sf)),
        },
        ["hadm_id"],
    ).frames
    return recommend.pair_counts(stored["codes"], stored["medications"])


_CSV_TABLES = ("nation", "supplier", "customer")


def _csv_ingest(spark, sf):
    raw, base = scratch_path(spark, "csv"), scratch_path(spark, "tables")
    for table in _CSV_TABLES:
        read_table(spark, sf, table).write.option("header", True).option(
            "compression", "gzip"
        ).csv(f"{raw}/{table}")
    return base, ingest_tables(spark, {t: f"{raw}/{t}" for t in _CSV_TABLES}, base)


@query(
    " UNION ALL ".join(
        f'SELECT \'{t}\' AS "table", COUNT(*) AS rows_in, COUNT(*) AS rows_out, TRUE AS ok FROM {t}'
        for t in _CSV_TABLES
    )
)
def csv_ingest(spark, sf):
    return _csv_ingest(spark, sf)[1].select("table", "rows_in", "rows_out", "ok")


@query(
    """
    SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
    FROM customer"""
)
def csv_typed(spark, sf):
    return read_table(spark, _csv_ingest(spark, sf)[0], "customer")
