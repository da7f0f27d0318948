from datetime import datetime

from helpers import plan, rows

from pyspark.sql import functions as F

from wardline import schemas as S
from wardline.config import StreamConfig
from wardline.operators import recommend, serving


def tables(spark):
    dx = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (3, None)], S.DIAGNOSES)
    rx = spark.createDataFrame(
        [(0, 1, "a", None), (0, 1, "a", None), (0, 1, "b", None), (0, 2, "b", None), (0, 3, "c", None), (0, 1, None, None)],
        S.PRESCRIPTIONS,
    )
    return dx, rx


def test_pairs_equal_the_row_by_row_join(spark):
    dx, rx = tables(spark)
    pairs = recommend.co_occurrence(dx, rx)
    brute = dx.join(rx, "hadm_id").dropna(subset=["icd_code", "drug"]).groupBy("icd_code", "drug").count()
    assert rows(pairs) == rows(brute)
    assert rows(pairs) == [("x", "a", 4), ("x", "b", 3), ("y", "a", 2), ("y", "b", 1)]


def test_ranking_and_summary(spark):
    pairs = spark.createDataFrame(
        [("x", "b", 3), ("x", "a", 3), ("x", "c", 1), ("y", "a", 2)], "icd_code string, drug string, pair_count long"
    )
    best = recommend.recommendations(pairs, 2)
    assert rows(best, "icd_code", "rank", "drug") == [("x", 1, "a"), ("x", 2, "b"), ("y", 1, "a")]
    assert rows(recommend.recommendation_summary(best)) == [(3, 2, 2, 1.5)]
    titles = spark.createDataFrame([("x", "Title X")], "icd_code string, title string")
    assert rows(recommend.with_titles(best, titles), "icd_code", "title")[-1] == ("y", None)
    assert "WindowGroupLimit" in plan(best)
    doubled = titles.unionByName(titles.withColumn("title", F.concat(F.lit("z "), "title")))
    assert rows(recommend.with_titles(best, doubled)) == rows(recommend.with_titles(best, titles))


def test_codes_are_told_apart_by_version(spark):
    diagnoses = spark.createDataFrame([(1, "x", 9), (1, "x", 10)], "hadm_id int, icd_code string, icd_version int")
    drugs = spark.createDataFrame([(1, "d")], "hadm_id int, drug string")
    titles = spark.createDataFrame([("x", 9, "nine"), ("x", 10, "ten")], "icd_code string, icd_version int, title string")
    best = recommend.recommendations(recommend.co_occurrence(diagnoses, drugs))
    assert rows(recommend.with_titles(best, titles), "icd_version", "title", "pair_count") == [(10, "ten", 1), (9, "nine", 1)]


def test_equal_times_and_offsets_follow_the_partition(spark):
    sent = spark.createDataFrame(
        [(1, 1, 5, "220045", 60.0), (1, 0, 5, "220045", 90.0), (1, 0, 9, "220045", 70.0)],
        "message_time int, partition int, offset int, itemid string, value double",
    ).withColumn("time", F.col("message_time"))
    assert rows(serving.latest_values(sent), "value") == rows(serving.panel_values(sent), "value") == [(60.0,)]


def test_tops(spark):
    dx, rx = tables(spark)
    assert rows(recommend.top_diagnoses(dx, rx)) == [("x", 7), ("y", 3)]
    assert [tuple(r) for r in recommend.top_medications(rx, 2).collect()] == [("a", 2), ("b", 2)]


def served(spark, *entries):
    return spark.createDataFrame(
        [(s, n, v, datetime.fromisoformat(t)) for s, n, v, t in entries],
        "subject_id string, vital_name string, valuenum double, event_time timestamp",
    )


def test_trend(spark):
    frame = served(
        spark,
        ("1", "heart_rate", 70.0, "2150-01-02 00:00:00"), ("1", "heart_rate", 71.0, "2150-01-01 00:00:00"),
        ("1", "heart_rate", 72.0, "2149-12-31 23:59:59"), ("1", "bp_diastolic", 73.0, "2150-01-02 00:00:00"),
        ("2", "spo2", 99.0, "2150-01-01 12:00:00"),
    )
    as_of = datetime(2150, 1, 2)
    got = serving.vital_trend(frame, "1", as_of=as_of).collect()
    assert [(r["value"], r["metric"]) for r in got] == [(71.0, "Heart Rate (bpm)"), (70.0, "Heart Rate (bpm)")]
    everyone = serving.vital_trend(frame, as_of=serving.newest_time(frame))
    assert rows(everyone, "metric") == [("Heart Rate (bpm)",)] * 2 + [("SpO2 (%)",)]
    assert rows(serving.between(frame, "5 minutes", datetime(2150, 1, 1)), "valuenum") == [(71.0,), (72.0,)]
    assert rows(serving.patient_list(frame)) == [("1",), ("2",)]


def test_window_reaches_the_scan(spark, fresh_dir):
    served(spark, ("1", "spo2", 1.0, "2150-01-01 00:00:00")).write.parquet(f"{fresh_dir}/t")
    text = plan(serving.vital_trend(spark.read.parquet(f"{fresh_dir}/t"), "1", as_of=datetime(2150, 1, 1)))
    assert "GreaterThanOrEqual(event_time" in text and "EqualTo(subject_id,1)" in text


def test_days_before_the_span_are_not_read(spark, fresh_dir):
    frame = served(
        spark, *[(str(s), "spo2", float(s), f"2150-01-{d:02d} 12:00:00") for s in range(20) for d in range(1, 6)]
    )
    serving.store_served(frame, f"{fresh_dir}/t")
    table = spark.read.parquet(f"{fresh_dir}/t")
    recent = serving.vital_trend(table, as_of=datetime(2150, 1, 5, 12))
    assert recent.count() == 40
    text = plan(recent)
    assert "event_date" in text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert rows(table.drop("event_date")) == rows(frame.select(*[c for c in table.columns if c != "event_date"]))


def test_last_values_follow_arrival(spark):
    frame = spark.createDataFrame(
        [(10, 1, "220045", "79.9"), (10, 2, "220045", "80"), (9, 3, "220045", "5"), (11, 4, "220045", None),
         (1, 5, "220277", "x"), (1, 6, "220050", "12"), (1, 7, "999", "1")],
        "message_time long, offset long, itemid string, value string",
    ).selectExpr("*", "message_time AS time")
    want = [("220045", 80.0, "red"), ("220050", 12.0, "green")]
    assert rows(serving.latest_values(frame)) == want
    assert rows(serving.panel_values(frame)) == want
    assert rows(serving.panel_values(frame, n=2)) == [("220045", 80.0, "red")]
    assert [r["offset"] for r in serving.last_messages(frame, n=3).collect()] == [4, 2, 1]
    assert rows(serving.waveform(frame, "220045"), "value")[0] == (5.0,)


def test_settings_from_the_environment():
    config = StreamConfig.from_env({"PG_HOST": "db", "PG_PORT": "1", "ROWS_PER_SECOND": "9", "KAFKA_TOPIC": "t"})
    assert config.jdbc_url == "jdbc:postgresql://db:1/database"
    assert (config.rows_per_second, config.kafka_topic) == (9, "t")
    assert StreamConfig.from_env({}) == StreamConfig()
