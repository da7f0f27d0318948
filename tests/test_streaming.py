import json

import pytest
from helpers import chart_row, charts, global_sequence, plan, rows
from pyspark.sql import functions as F

from wardline import schemas as S
from wardline.config import StreamConfig
from wardline.functions.messages import decode, encode
from wardline.operators import ordering
from wardline.operators.ordering import dense_sequence
from wardline.sources.messages import echo_lines, message_writer, read_messages
from wardline.streaming import ingest, replay

TIMEOUT = 120


def test_distributed_numbers_equal_the_global_window(spark):
    frame = spark.range(20_000).select(
        # A third of the rows share one value.
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000))).alias("k"), "id"
    )
    ours = dense_sequence(frame, ["k", "id"])
    assert ours.exceptAll(global_sequence(frame, ["k", "id"])).isEmpty()
    assert ours.count() == 20_000
    ordering = plan(ours)
    assert "Exchange SinglePartition" not in ordering[: ordering.index("BroadcastExchange")]


def test_large_inputs_get_more_ranges(spark, monkeypatch):
    frame = spark.range(5_000).selectExpr("id % 7 AS k", "id")
    monkeypatch.setattr(ordering, "partitions_for", lambda df: 50)
    ours = dense_sequence(frame, ["k", "id"])
    assert len(ours.inputFiles()) == 50
    assert ours.exceptAll(global_sequence(frame, ["k", "id"])).isEmpty()


def history_rows(spark):
    return charts(
        spark,
        (1, 220045, "70", "2150-01-01 00:00:02", None), (1, 220045, "71", None, "2150-01-01 00:00:01"),
        (1, 220045, "72", "bad", None), (1, 220045, "73", None, None),
        (1, 999, "74", "2150-01-01 00:00:00", None), (1, 220277, "98", "2150-01-01 00:00:02", None),
        (1, 220045, "75", "2150-01-01 00:00:02", None),
    )


def test_history_order_fallback_and_drops(spark):
    got = replay.replay_history(history_rows(spark), subject_id=1).orderBy("seq").collect()
    assert [r["seq"] for r in got] == [0, 1, 2, 3]
    assert got[0]["value"] == "71" and got[3]["value"] == "98"
    assert {got[1]["value"], got[2]["value"]} == {"70", "75"}
    assert got[3]["vital_name"] == "spo2" and "icustay_id" not in got[0].asDict()
    with pytest.raises(ValueError):
        replay.replay_history(history_rows(spark), subject_id=2)


def test_copies_of_one_event_are_spread(spark):
    event = chart_row(1, 220045, "70", "2150-01-01 00:00:30")
    others = [chart_row(1, 220045, "71", f"2150-01-01 00:00:{i % 60:02d}") for i in range(100)]
    frame = spark.createDataFrame([event, *others], S.CHARTEVENTS)
    copies = frame.join(spark.range(1_000).hint("broadcast"), F.col("value") == "70").drop("id")
    # The partitions are tiny; without this they would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        history = replay.replay_history(frame.filter("value = '71'").union(copies.repartition(8)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(history.groupBy("value").count()) == [("70", 1_000), ("71", 100)]
    assert history.agg(F.max("seq"), F.count_distinct("seq")).first() == (1_099, 1_100)
    assert max(spark.read.parquet(f).count() for f in history.inputFiles()) < 500


def test_ticks_wrap_around(spark):
    history = replay.replay_history(history_rows(spark))
    ticks = spark.range(10).withColumnRenamed("id", "tick")
    assert rows(replay.replay(ticks, history).groupBy("seq").count()) == [(0, 3), (1, 3), (2, 2), (3, 2)]
    with pytest.raises(ValueError):
        replay.replay(ticks, history, 0)


def test_message_text(spark):
    history = replay.replay_history(history_rows(spark)).filter("seq = 0")
    message = encode(history).first()
    assert message["key"] is None
    assert json.loads(message["value"]) == {
        "subject_id": 1, "hadm_id": 10, "itemid": "220045", "vital_name": "heart_rate", "value": "71",
        "valuenum": "71", "valueuom": "unit", "storetime": "2150-01-01T00:00:01.000Z",
        "event_time": "2150-01-01T00:00:01.000Z",
    }


def rate(spark, per_batch):
    return replay.clock(
        spark, fmt="rate-micro-batch", options={"rowsPerBatch": per_batch, "numPartitions": 2, "startTimestamp": 0}
    )


def test_stream_gives_the_same_messages_as_batch(spark, fresh_dir):
    history = replay.replay_history(history_rows(spark))
    messages = replay.replay_messages(rate(spark, 10), history).select("value")
    writer = message_writer(messages, StreamConfig(), f"{fresh_dir}/cp", "text", f"{fresh_dir}/out")
    ingest.finish(writer.trigger(availableNow=True).start(), TIMEOUT)
    batch = replay.replay_messages(spark.range(10).withColumnRenamed("id", "tick"), history)
    assert rows(spark.read.text(f"{fresh_dir}/out")) == rows(batch, "value")


@pytest.mark.parametrize("first, last", [(0, 2), (3, 5), (2, 9), (4, 4), (0, 0)])
def test_slices_equal_the_full_replay(spark, first, last):
    history = replay.store_history(replay.replay_history(history_rows(spark)))
    ticks = spark.range(first, last + 1).withColumnRenamed("id", "tick")
    assert rows(replay.replay_slice(ticks, history, 4), "seq") == rows(replay.replay(ticks, history, 4), "seq")


def test_slice_reads_only_its_range(spark):
    history = replay.store_history(spark.range(1_000).withColumnRenamed("id", "seq"))
    ticks = spark.range(1_995, 2_005).withColumnRenamed("id", "tick")
    sliced = replay.replay_slice(ticks, history, 1_000)
    assert "GreaterThanOrEqual(seq,995)" in plan(sliced)
    assert rows(sliced, "seq") == sorted([(s % 1_000,) for s in range(995, 1_005)], key=str)
    assert replay.replay_slice(ticks.limit(0), history, 1_000).isEmpty()


def test_stored_history_has_disjoint_ranges(spark, monkeypatch):
    monkeypatch.setattr(replay, "HISTORY_FILE_BYTES", 1_000)
    history = replay.store_history(spark.range(10_000).withColumnRenamed("id", "seq").repartition(7))
    ends = history.groupBy(F.input_file_name()).agg(F.min("seq"), F.max("seq")).collect()
    ranges = sorted((low, high) for _, low, high in ends)
    assert len(ranges) > 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_ids_that_became_doubles_replay_without_rejects(spark):
    events = history_rows(spark).withColumn("itemid", F.col("itemid").cast("double"))
    sent = decode(replay.encode(replay.replay_history(events)))
    assert sent.count() > 0 and sent.filter("reject_reason IS NOT NULL OR vital_name IS NULL").isEmpty()


def test_large_history_stream(spark, fresh_dir):
    history = replay.store_history(replay.replay_history(history_rows(spark)))

    def emit(messages, batch_id):
        messages.select("value").write.mode("overwrite").text(f"{fresh_dir}/out/batch={batch_id}")

    writer = replay.replay_writer(rate(spark, 6), history, 4, emit, f"{fresh_dir}/cp")
    ingest.finish(writer.trigger(availableNow=True).start(), TIMEOUT)
    batch = replay.replay_messages(spark.range(6).withColumnRenamed("id", "tick"), history)
    assert rows(spark.read.text(f"{fresh_dir}/out"), "value") == rows(batch, "value")


MESSAGES = [
    '{"subject_id": 1, "itemid": "220045", "vital_name": "heart_rate", "value": "70", "valuenum": 70.5, '
    '"event_time": "2150-01-01T00:00:00.000Z"}',
    '{"subject_id": 2, "itemid": "220277", "valuenum": "", "event_time": "2150-01-01T00:00:01.000Z"}',
    '{"subject_id": 3, "itemid": null, "valuenum": null}',
    '{"subject_id": 4, "itemid": "x"}',
    '{"subject_id": 5, "itemid": "1", "valuenum": "high"}',
    '{"subject_id": 6, "event_time": "yesterday-ish"}',
    '{"subject_id": 7',
    "",
    "[1]",
]


def test_decode_sorts_sound_from_broken(spark):
    frame = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    got = decode(frame).collect()
    assert [r["reject_reason"] for r in got] == [
        None, None, None, "bad_itemid", "bad_valuenum", "bad_time", "malformed", "malformed", "malformed",
    ]
    assert got[0]["subject_id"] == "1" and got[0]["valuenum"] == 70.5
    assert got[0]["timestamp"] == got[0]["event_time"] and got[0]["hadm_id"] is None
    assert got[1]["valuenum"] is None and got[2]["itemid"] is None


def test_loader_keeps_going_and_repeats_safely(spark, fresh_dir):
    topic = f"{fresh_dir}/topic"
    spark.createDataFrame([(m,) for m in MESSAGES if m], "value string").repartition(3).write.text(topic)

    def load(sink):
        stream = read_messages(spark, StreamConfig(), "text", topic, {"maxFilesPerTrigger": "1"})
        writer = ingest.load_messages(
            stream, sink, ingest.parquet_sink(f"{fresh_dir}/rejects"), f"{fresh_dir}/cp", {"availableNow": True}
        )
        return ingest.finish(writer.start(), TIMEOUT)

    table = ingest.parquet_sink(f"{fresh_dir}/table")
    failed = []

    def fails_once(frame, batch_id):
        table(frame, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    with pytest.raises(Exception, match="lost after writing"):
        load(fails_once)
    load(fails_once)
    stored = spark.read.parquet(f"{fresh_dir}/table")
    assert rows(stored, "subject_id") == [("1",), ("2",), ("3",)]
    assert stored.filter("created_at IS NULL").isEmpty()
    assert rows(stored.filter("timestamp IS NULL"), "subject_id") == [("3",)]
    days = ingest.day_sink(f"{fresh_dir}/days")
    for batch_id in (0, 1, 0):
        days(stored.filter(F.col("subject_id") == str(batch_id + 1)), batch_id)
    by_day = spark.read.parquet(f"{fresh_dir}/days")
    assert rows(by_day, "subject_id", "event_date") == rows(stored.filter("event_time IS NOT NULL").selectExpr("subject_id", "DATE(event_time)"))
    assert "PartitionFilters: [isnotnull(event_date" in plan(by_day.filter("event_date >= DATE'2150-01-01'"))
    ingest.compact_days(spark, f"{fresh_dir}/days", f"{fresh_dir}/compact")
    assert rows(spark.read.parquet(f"{fresh_dir}/compact"), "subject_id") == [("1",), ("2",)]
    rejects = spark.read.parquet(f"{fresh_dir}/rejects")
    assert rejects.count() == 5 and rejects.first()["topic"] == StreamConfig().kafka_topic


def test_endless_stream_is_stopped(spark, fresh_dir):
    writer = message_writer(
        replay.clock(spark, 1).select(F.col("tick").cast("string").alias("value")),
        StreamConfig(), f"{fresh_dir}/cp", "text", f"{fresh_dir}/out",
    )
    running = writer.start()
    with pytest.raises(TimeoutError):
        ingest.finish(running, 1)
    assert not running.isActive


def test_echo_names_the_place(spark):
    frame = spark.createDataFrame([("{}", "t", 3, 7)], "value string, topic string, partition int, offset long")
    assert rows(echo_lines(frame)) == [("t/3/7", "{}")]
