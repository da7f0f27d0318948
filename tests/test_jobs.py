import gzip
import json

import pytest
from helpers import chart_row, rows

from wardline import schemas as S
from wardline.config import StreamConfig
from wardline.plans import jobs
from wardline.streaming import ingest, replay

TIMEOUT = 120


@pytest.fixture()
def base(spark, fresh_dir):
    """The clinical tables on a small scale: ten stays, five with abnormal readings."""
    readings = [
        chart_row(100 + s, item, str(value), f"2150-01-01 00:{s:02d}:{i:02d}", subject=s, hadm=s)
        for s in range(10)
        for i, (item, value) in enumerate([(220045, 50 if s < 5 else 70), (220277, 95), (220050, 150 if s < 2 else 120)])
    ]
    tables = {
        "chartevents": (readings, S.CHARTEVENTS),
        "prescriptions": (
            [(s, s, d, "2150-01-01 08:00:00") for s in range(10) for d in ("a", "b", "b") if d == "b" or s < 7],
            S.PRESCRIPTIONS,
        ),
        "icustays": ([(s, s, 100 + s) for s in range(10)], S.ICUSTAYS),
        "diagnoses_icd": ([(s, "x" if s < 8 else "y") for s in range(10)], S.DIAGNOSES),
    }
    for name, (entries, schema) in tables.items():
        spark.createDataFrame(entries, schema).write.parquet(f"{fresh_dir}/data/{name}.parquet")
    spark.createDataFrame([("x", "Title X")], "icd_code string, title string").write.parquet(
        f"{fresh_dir}/data/d_icd_diagnoses.parquet"
    )
    return fresh_dir


def test_features(spark, base):
    built = jobs.feature_job(spark, f"{base}/data", f"{base}/out")
    assert rows(built.features, "stay_id") == [(100 + s,) for s in range(5)]
    assert rows(spark.read.parquet(f"{base}/out/vocabulary"), "position", "drug") == [(0, "b"), (1, "a")]
    vectors = {r["stay_id"]: r for r in spark.read.parquet(f"{base}/out/features").collect()}
    assert list(vectors[100]["clinical_features"].toArray()) == [1, 1, 0, 0, 0, 0, 1, 2, 2, 1.0]
    assert list(vectors[100]["drug_features"].toArray()) == [2, 1]
    figures = {(r["section"], r["metric"]): r["value"] for r in spark.read.parquet(f"{base}/out/report").collect()}
    assert figures["dataset", "icu_stays"] == 5 and figures["top_drugs", "a"] == 5
    assert figures["flags", "hr_abnormal=1"] == 5 and figures["flags", "bp_abnormal=1"] == 2
    assert rows(spark.read.parquet(f"{base}/out/drug_statistics")) == [("b", 20, 10)]


def test_recommendations(spark, base):
    summary = jobs.recommendation_job(spark, f"{base}/data", f"{base}/out", k=1)
    assert rows(summary) == [(2, 2, 1, 1.0)]
    assert rows(spark.read.parquet(f"{base}/out"), "icd_code", "title", "drug", "pair_count") == [
        ("x", "Title X", "b", 16), ("y", None, "b", 4),
    ]


def test_replay_then_load(spark, base):
    config = StreamConfig(base_path=base)
    ticks = replay.clock(
        spark, fmt="rate-micro-batch", options={"rowsPerBatch": 45, "numPartitions": 2, "startTimestamp": 0}
    )
    writer = jobs.replay_job(
        spark, config, f"{base}/cp1", ticks=ticks, fmt="text", path=f"{base}/topic"
    )
    ingest.finish(writer.trigger(availableNow=True).start(), TIMEOUT)
    sent = [json.loads(r[0]) for r in spark.read.text(f"{base}/topic").select("value").collect()]
    assert len(sent) == 45 and {m["itemid"] for m in sent} == {"220045", "220277", "220050"}

    loader = jobs.load_job(
        spark, config, f"{base}/cp2", ingest.parquet_sink(f"{base}/table"), ingest.parquet_sink(f"{base}/rejects"),
        "text", f"{base}/topic/*", {"availableNow": True},
    )
    ingest.finish(loader.start(), TIMEOUT)
    table = spark.read.parquet(f"{base}/table")
    assert table.count() == 45 and spark.read.parquet(f"{base}/rejects").isEmpty()
    # 30 events over 45 ticks: the first 15 come twice.
    twice = table.groupBy("event_time", "itemid").count().filter("count = 2")
    assert twice.count() == 15


def test_ingest_raises_when_a_table_is_missing(spark, fresh_dir):
    with gzip.open(f"{fresh_dir}/t.csv.gz", "wt") as out:
        out.write("a\n1\n")
    assert jobs.ingest_job(spark, {"t": f"{fresh_dir}/t.csv.gz"}, fresh_dir).count() == 1
    with pytest.raises(RuntimeError):
        jobs.ingest_job(spark, {"u": f"{fresh_dir}/u.csv.gz"}, fresh_dir)


def test_signals(spark, base):
    out = jobs.signal_job(spark, f"{base}/data", f"{base}/signals")
    pressure = out.selectExpr("stay_id", "exists(abnormal_signals, x -> x.itemid = 220050) AS bp")
    assert rows(pressure) == [(100, True), (101, True), (102, False), (103, False), (104, False)]
