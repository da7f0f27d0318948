import pytest
from helpers import charts, plan, rows
from pyspark.sql import functions as F

from wardline import schemas as S
from wardline.operators import vitals
from wardline.schemas import Band


@pytest.mark.parametrize(
    "item, value, expected",
    [
        (220045, "60", 0), (220045, "100", 0), (220045, "59.9", 1), (220045, "100.1", 1),
        (220050, "90", 0), (220050, "140", 0), (220050, "89.9", 1), (220050, "140.5", 1),
        (220051, "60", 0), (220051, "90", 0), (220051, "59", 1), (220051, "91", 1),
        (220277, "90", 0), (220277, "89.9", 1), (220277, "101", 0),
        (220210, "12", 0), (220210, "20", 0), (220210, "11.5", 1), (220210, "20.5", 1),
        (223762, "36", 0), (223762, "37.8", 0), (223762, "35.9", 1), (223762, "37.9", 1),
    ],
)
def test_bounds_are_normal(spark, item, value, expected):
    got = vitals.abnormal_charts(charts(spark, (1, item, value))).collect()
    assert [r["is_abnormal"] for r in got] == [expected]


def test_gate_drops_what_cannot_be_classified(spark):
    frame = charts(
        spark,
        (1, 220045, "0"), (1, 220045, "-1"), (1, 220045, "1000"), (1, 220045, None),
        (1, 220045, "abc"), (1, 220045, ""), (None, 220045, "70"), (1, 999, "70"),
        (1, 220045, "0.1"), (1, 220045, "999.9"),
    )
    assert rows(vitals.gate_vitals(frame), "valuenum_double") == [(0.1,), (999.9,)]


def test_item_ids_may_be_text(spark):
    frame = charts(spark, (1, 220045, "59")).withColumn("itemid", F.col("itemid").cast("string"))
    assert vitals.abnormal_charts(frame).first()["is_abnormal"] == 1


def test_unknown_item_is_not_abnormal(spark):
    frame = charts(spark, (1, 999, "5")).withColumn("valuenum_double", F.lit(5.0))
    assert vitals.classify(frame).first()["is_abnormal"] == 0


def test_filters_reach_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("user_id").alias("stay_id"), F.col("event_type").alias("itemid"),
        F.col("value").alias("valuenum"),
    )
    bands = (Band("click", "heart_rate", "hr_abnormal", 1.0, 2.0),)
    text = plan(vitals.abnormal_summary(vitals.abnormal_charts(events, bands), bands))
    pushed = text[text.index("PushedFilters"):]
    assert "EqualTo(event_type,click)" in pushed or "In(event_type" in pushed
    assert "GreaterThan(value,0.0)" in pushed and "LessThan(value,1000.0)" in pushed
    assert "props" not in text and text.count("Exchange") == 1


def test_unknown_items_keep_a_null_label(spark):
    items = spark.createDataFrame([(220045, "Heart Rate")], S.D_ITEMS)
    named = vitals.name_items(charts(spark, (1, 220045, "70"), (1, 5, "70")), items)
    assert rows(named, "itemid", "label") == [(220045, "Heart Rate"), (5, None)]


def test_summary_of_a_stay(spark):
    frame = charts(
        spark,
        (1, 220045, "50"), (1, 220045, "120"), (1, 220277, "80"), (1, 220277, "95"),
        (2, 220210, "15"), (3, 223762, "39"),
    )
    summary = vitals.abnormal_summary(vitals.abnormal_charts(frame))
    got = {r["stay_id"]: r for r in summary.collect()}
    assert set(got) == {1, 3}
    assert got[1]["total_abnormal_count"] == 3 and got[1]["unique_abnormal_types"] == 2
    assert got[1]["avg_abnormal_value"] == pytest.approx(250 / 3)
    assert (got[1]["min_abnormal_value"], got[1]["max_abnormal_value"]) == (50.0, 120.0)
    flags = {b.flag: got[1][b.flag] for b in S.VITAL_BANDS}
    assert flags == {
        "hr_abnormal": 1, "bp_sys_abnormal": 0, "bp_dia_abnormal": 0,
        "spo2_abnormal": 1, "rr_abnormal": 0, "temp_abnormal": 0,
    }
    assert got[3]["temp_abnormal"] == 1


def test_one_stay_with_most_rows_is_combined_before_the_shuffle(spark):
    hot = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("stay_id"),
        F.lit(220045).cast("long").alias("itemid"),
        F.lit(50.0).alias("valuenum"),
    )
    summary = vitals.abnormal_summary(vitals.abnormal_charts(hot))
    assert "partial_count" in plan(summary)
    assert summary.filter("stay_id = 7").first()["total_abnormal_count"] == 40_000 // 3 + 1 + 1


def test_segments_keep_every_signal_in_order(spark):
    hot = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("stay_id"),
        F.lit(220045).cast("long").alias("itemid"),
        (F.lit(1.0) + F.col("id") % 50).alias("valuenum"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(500))).alias("charttime"),
        F.col("id").alias("row_id"),
    )
    classified = vitals.abnormal_charts(hot)
    segments = vitals.signal_segments(classified, "row_id", segment_rows=100).collect()
    assert max(len(s["abnormal_signals"]) for s in segments) <= 100
    wanted = [
        (r["valuenum_double"], r["charttime"])
        for r in classified.filter("stay_id = 1").orderBy("charttime", "row_id").collect()
    ]
    ours = sorted((s for s in segments if s["stay_id"] == 1), key=lambda s: s["segment"])
    got = [(x["valuenum_double"], x["charttime"]) for s in ours for x in s["abnormal_signals"]]
    assert got == wanted and len(got) == 1001
    assert sum(len(s["abnormal_signals"]) for s in segments) == 3_000
