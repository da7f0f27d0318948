import random

from helpers import charts, plan, rows
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline import schemas as S
from wardline.operators import features as ft
from wardline.operators import meds, report
from wardline.plans import flows


def prescriptions(spark, *entries):
    return spark.createDataFrame(list(entries), S.PRESCRIPTIONS)


def stays(spark, *entries):
    return spark.createDataFrame(list(entries), S.ICUSTAYS)


def test_admission_with_two_stays_gives_both_all_prescriptions(spark):
    rx = prescriptions(
        spark,
        (1, 10, "a", "2150-01-01 08:00:00"), (1, 10, "a", "2150-01-01 20:00:00"),
        (1, 10, "b", "bad time"), (1, 10, None, "2150-01-01 08:00:00"),
        (2, 20, "c", None), (3, 30, "d", "2150-01-01 01:00:00"), (1, 11, "a", "2150-01-01 08:00:00"),
    )
    icu = stays(spark, (1, 10, 100), (1, 10, 101), (2, 20, 200), (3, 30, None), (9, 11, 900))
    drugs = meds.stay_drugs(rx, icu)
    assert rows(drugs, "stay_id", "drug", "n_rx") == [
        (100, "a", 2), (100, "b", 1), (101, "a", 2), (101, "b", 1), (200, "c", 1),
    ]
    got = rows(
        meds.medication_summary(drugs),
        "stay_id", "total_prescriptions", "unique_drugs", "prescription_hours",
    )
    assert got == [(100, 3, 2, [8, 20]), (101, 3, 2, [8, 20]), (200, 1, 1, [])]


def test_repeated_stay_rows_repeat_prescriptions(spark):
    rx = prescriptions(spark, (1, 10, "a", None), (1, 10, "a", None))
    icu = stays(spark, (1, 10, 100), (1, 10, 100), (1, 10, 100))
    assert rows(meds.stay_drugs(rx, icu), "n_rx") == [(6,)]


def test_same_numbers_as_joining_row_by_row(spark):
    rng = random.Random(3)
    rx = prescriptions(
        spark,
        *[
            # A third of all prescriptions belong to admission 0.
            (1, rng.choice([0, 0, *range(1, 5)]), rng.choice([None, *"abcdef"]),
             f"2150-01-01 {rng.randrange(24):02d}:00:00")
            for _ in range(800)
        ],
    )
    icu = stays(spark, *[(1, h, rng.choice([None, h * 10, h * 10 + 1])) for h in range(5) for _ in range(3)])
    joined = (
        rx.join(icu, ["subject_id", "hadm_id"])
        .filter("stay_id IS NOT NULL AND drug IS NOT NULL")
        .groupBy("stay_id")
        .agg(
            F.count("drug").alias("total_prescriptions"),
            F.count_distinct("drug").alias("unique_drugs"),
            F.array_sort(F.collect_set(F.hour(F.col("starttime").try_cast("timestamp")))).alias("h"),
        )
    )
    ours = meds.medication_summary(meds.stay_drugs(rx, icu)).withColumnRenamed("prescription_hours", "h")
    columns = ("stay_id", "total_prescriptions", "unique_drugs", "h")
    assert rows(ours, *columns) == rows(joined, *columns)


def test_drug_thresholds(spark):
    def many(drug, count, patients):
        return [(1, p, drug, None) for p in range(patients) for _ in range(count // patients)] + [
            (1, 0, drug, None) for _ in range(count % patients)
        ]

    rx = prescriptions(spark, *many("few patients", 10, 4), *many("few rows", 9, 5), *many("kept", 10, 5))
    icu = stays(spark, *[(1, p, 100 + p) for p in range(5)])
    statistics = meds.drug_statistics(meds.stay_drugs(rx, icu))
    assert rows(statistics) == [("kept", 10, 5)]


def test_top_drugs_break_ties_by_name(spark):
    stats = spark.createDataFrame([("b", 5, 1), ("a", 5, 1), ("c", 9, 1)], "drug string, drug_count long, unique_patients long")
    assert [r["drug"] for r in meds.top_drugs(stats, 2).collect()] == ["c", "a"]


def test_drug_segments_hold_the_whole_list(spark):
    drugs = spark.createDataFrame(
        [(s, f"d{i:03d}", i + 1) for s in (1, 2) for i in range(25)], "stay_id long, drug string, n_rx long"
    )
    segments = meds.drug_segments(drugs, segment_rows=10).orderBy("stay_id", "segment").collect()
    assert all(len(s["prescribed_drugs"]) <= 10 for s in segments)
    for stay in (1, 2):
        entries = [tuple(d) for s in segments if s["stay_id"] == stay for d in s["prescribed_drugs"]]
        assert entries == [(f"d{i:03d}", i + 1) for i in range(25)]


def test_only_stays_with_both_sides(spark):
    frame = charts(spark, (100, 220050, "80"), (100, 220045, "50"), (100, 220045, "55"), (300, 220045, "50"), (400, 220045, "70"))
    rx = prescriptions(spark, (1, 10, "a", None), (1, 11, "a", None), (1, 12, "a", None))
    icu = stays(spark, (1, 10, 100), (1, 11, 200), (1, 12, 400))
    got = flows.stay_features(frame, rx, icu).collect()
    assert [r["stay_id"] for r in got] == [100]
    assert got[0]["bp_abnormal"] == 1 and got[0]["bp_dia_abnormal"] == 0
    assert got[0]["abnormal_count_ratio"] == 1.5


def drug_rows(spark, seed=5, stays=40):
    rng = random.Random(seed)
    out = {}
    for stay in range(stays):
        for _ in range(rng.randrange(1, 30)):
            key = (stay, f"drug{min(rng.randrange(40), rng.randrange(40)):02d}")
            out[key] = out.get(key, 0) + 1
    return spark.createDataFrame([(s, d, n) for (s, d), n in out.items()], "stay_id long, drug string, n_rx long")


def test_vocabulary_equals_count_vectorizer(spark):
    drugs = drug_rows(spark)
    lists = drugs.groupBy("stay_id").agg(
        F.flatten(F.collect_list(F.expr("array_repeat(drug, int(n_rx))"))).alias("drugs_list")
    )
    model = CountVectorizer(inputCol="drugs_list", outputCol="v", vocabSize=30, minDF=5.0).fit(lists)
    vocab = ft.vocabulary(drugs)
    counts = {r["drug"]: r["term_count"] for r in ft.term_frequencies(drugs).collect()}
    ours = ft.vocabulary_terms(vocab)
    assert [counts[d] for d in ours] == [counts[d] for d in model.vocabulary]
    last = counts[ours[-1]]
    assert {d for d in ours if counts[d] > last} == {d for d in model.vocabulary if counts[d] > last}

    theirs = {
        r["stay_id"]: dict(zip(model.vocabulary, r["v"]))
        for r in model.transform(lists).select("stay_id", vector_to_array("v").alias("v")).collect()
    }
    shared = [d for d in ours if d in model.vocabulary]
    for row in ft.drug_counts(drugs, ours).collect():
        mine = dict(zip(ours, row[1:]))
        assert [mine[d] for d in shared] == [theirs[row["stay_id"]][d] for d in shared]


def test_vectors_follow_the_fixed_order(spark):
    features = spark.createDataFrame(
        [(1, 1, 0, 1, 0, 1, 0, 1, 6, 3, 2.0)], "stay_id long, " + ", ".join(
            f"{c} {'double' if c == 'abnormal_count_ratio' else 'long'}" for c in S.CLINICAL_FEATURES
        ),
    )
    drugs = spark.createDataFrame([(1, "a", 2), (1, "z", 9)], "stay_id long, drug string, n_rx long")
    row = ft.vectorize(features, drugs, ["b", "a"]).first()
    assert list(row["clinical_features"].toArray()) == [1, 0, 1, 0, 1, 0, 1, 6, 3, 2.0]
    assert list(row["drug_features"].toArray()) == [0, 2]


def test_report_figures(spark):
    features = spark.createDataFrame(
        [(1, 1, 0, 0, 0, 0, 2, 4), (2, 0, 0, 0, 0, 1, 1, 2)],
        "stay_id long, hr_abnormal int, bp_abnormal int, spo2_abnormal int, rr_abnormal int, "
        "temp_abnormal int, unique_abnormal_types long, total_prescriptions long",
    )
    distribution = report.flag_distribution(features).filter("flag = 'hr_abnormal'")
    assert rows(distribution) == [("hr_abnormal", 0, 1), ("hr_abnormal", 1, 1)]
    figures = {r["metric"]: r["value"] for r in report.dataset_report(features, features, 7).collect()}
    assert figures["icu_stays"] == 2 and figures["retention_pct"] == 100
    assert figures["drugs_in_model"] == 7 and figures["avg_drugs_per_stay"] == 3
    assert figures["stays_with_2_types"] == 1 and figures["stays_with_2_types_pct"] == 50
    drugs = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "c", 1), (2, "a", 1)], "stay_id long, drug string, n_rx long")
    share = report.top_drug_share(features, drugs, min_stays=1)
    assert rows(share, "drug", "stays", "percentage")[0] == ("a", 2, 100.0)
    sample = report.sample_rows(features, drugs)
    assert rows(sample, "stay_id", "sample_drugs") == [(1, ["a", "a", "b"]), (2, ["a"])]


def test_schema_report(spark):
    frame = spark.createDataFrame([(1, "a")], "stay_id long, drug string")
    assert rows(report.schema_report(frame)) == [(0, "stay_id", "bigint"), (1, "drug", "string")]


def test_counts_come_before_the_join(spark):
    rx = spark.range(100).selectExpr("1L AS hadm_id", "'d' || id % 5 AS drug", "NULL AS starttime")
    icu = spark.range(100).selectExpr("1L AS hadm_id", "id % 2 AS stay_id")
    drugs = meds.stay_drugs(rx, icu, ("hadm_id",))
    text = plan(drugs)
    # Below the join: both inputs combined in their own tasks, then merged.
    below = text[text.index("Join") :]
    assert below.count("HashAggregate") == 4 and below.count("partial_count") == 2
    assert rows(drugs, "stay_id", "drug", "n_rx") == [(s, f"d{d}", 1000) for s in (0, 1) for d in range(5)]
