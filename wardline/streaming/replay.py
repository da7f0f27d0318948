"""Replays a recorded history, one event per clock tick, over and over."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wardline.config import StreamConfig
from wardline.functions.messages import encode
from wardline.functions.parsing import as_time, event_time, id_text, ids_for
from wardline.operators.ordering import dense_sequence
from wardline.operators.quality import require_rows
from wardline.schemas import VITAL_BANDS, Band
from wardline.session import lookup_side, materialize, partitions_for
from wardline.sources.tables import select_existing, vital_map

# Columns an event carries, as far as the history has them.
EVENT_COLUMNS = [
    "subject_id", "hadm_id", "icustay_id", "itemid", "value", "valuenum",
    "valueuom", "charttime_ts", "storetime_ts", "event_time",
]


# Events of a micro-batch are a range of the history, so its files are small.
HISTORY_FILE_BYTES = 32 * 1024 * 1024


def with_event_time(charts: DataFrame) -> DataFrame:
    """Parsed times and ``event_time``; readings without any time are dropped."""
    chart, store = as_time("charttime"), as_time("storetime")
    return charts.filter(chart.isNotNull() | store.isNotNull()).withColumns(
        {"charttime_ts": chart, "storetime_ts": store, "event_time": event_time()}
    )


def name_vitals(events: DataFrame, bands: tuple[Band, ...] = VITAL_BANDS) -> DataFrame:
    """Adds ``itemid_str`` and ``vital_name``. The map has one row per band."""
    names = vital_map(events.sparkSession, bands).withColumnRenamed("itemid", "itemid_str")
    text = id_text("itemid", events.schema["itemid"].dataType)
    return events.withColumn("itemid_str", text).join(
        F.broadcast(names), "itemid_str", "left"
    )


def replay_history(
    charts: DataFrame,
    subject_id: int | str | None = None,
    bands: tuple[Band, ...] = VITAL_BANDS,
    row_id: str | None = None,
) -> DataFrame:
    """The monitored events in time order, numbered from 0 in ``seq``.

    Events with equal time and item follow ``row_id`` if given, then their
    place in the scanned files. The place also lets many copies of one event
    spread over partitions. It repeats if a task does, as nothing is shuffled
    before the numbering, and the numbered history is stored once, so every
    micro-batch sees the same order.
    """
    if subject_id is not None:
        charts = charts.filter(F.col("subject_id") == subject_id)
    ids = ids_for(charts.schema["itemid"].dataType, [b.itemid for b in bands])
    events = with_event_time(charts.filter(F.col("itemid").isin(ids))).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    ties = ["_row"] if row_id is None else [row_id, "_row"]
    named = name_vitals(select_existing(events, [*EVENT_COLUMNS, *ties]), bands)
    numbered = dense_sequence(named, ["event_time", "itemid_str", *ties])
    return require_rows(numbered.drop("_row"), "replay history")


def clock(
    spark: SparkSession, rows_per_second: int = 2, fmt: str = "rate", options: dict | None = None
) -> DataFrame:
    """Unbounded ``tick_ts, tick``."""
    options = {"rowsPerSecond": rows_per_second} if options is None else options
    return (
        spark.readStream.format(fmt)
        .options(**options)
        .load()
        .withColumnsRenamed({"value": "tick", "timestamp": "tick_ts"})
    )


def replay(ticks: DataFrame, history: DataFrame, length: int | None = None) -> DataFrame:
    """The event of each tick; after the last event the history starts over.

    Works on batch and streaming ticks. A history within the measured limit is
    broadcast; a larger one is joined by shuffle. To stream a large history,
    take :func:`replay_writer`, which reads only what a micro-batch needs.
    """
    length = history.count() if length is None else length
    return _on_seq(ticks, lookup_side(history), length)


def _on_seq(ticks: DataFrame, history: DataFrame, length: int) -> DataFrame:
    if length == 0:
        raise ValueError("nothing to replay")
    return (
        ticks.withColumn("seq", F.col("tick") % F.lit(length))
        .join(history, "seq")
        .drop("tick", "tick_ts")
    )


def replay_messages(ticks: DataFrame, history: DataFrame, length: int | None = None) -> DataFrame:
    """The replayed events as ``(key, value)`` JSON messages."""
    return encode(replay(ticks, history, length))


def store_history(history: DataFrame) -> DataFrame:
    """The numbered history as a scratch table whose files cover narrow ``seq`` ranges that do not overlap."""
    parts = partitions_for(history, target_bytes=HISTORY_FILE_BYTES)
    return materialize(history.repartitionByRange(parts, "seq").sortWithinPartitions("seq"), "history")


def replay_slice(ticks: DataFrame, history: DataFrame, length: int) -> DataFrame:
    """Replay of a batch of ticks that reads only the events between its ends.

    Ticks of a batch follow each other, so their events are one range of
    ``seq``, or two where the history starts over. The range filter reaches
    the scan of a stored history.
    """
    first, last = ticks.agg(F.min("tick"), F.max("tick")).first()
    if first is None:
        return _on_seq(ticks, history, length)
    seq = F.col("seq")
    start, end = first % length, last % length
    if last - first + 1 >= length:
        needed = history
    elif start <= end:
        needed = history.filter(seq.between(start, end))
    else:
        needed = history.filter((seq >= start) | (seq <= end))
    return _on_seq(ticks, needed, length)


def replay_writer(
    ticks: DataFrame,
    history: DataFrame,
    length: int,
    emit: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> DataStreamWriter:
    """Replay a stored history of any size; ``emit`` gets each batch's ``(key, value)``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        emit(encode(replay_slice(batch, history, length)), batch_id)

    return ticks.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)


def kafka_emit(config: StreamConfig) -> Callable[[DataFrame, int], None]:
    """Sends a batch of messages to the topic."""

    def emit(messages: DataFrame, batch_id: int) -> None:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", config.kafka_bootstrap)
            .option("topic", config.kafka_topic)
            .save()
        )

    return emit


def file_emit(fmt: str, path: str) -> Callable[[DataFrame, int], None]:
    """Writes the message texts of a batch to a folder of its own."""

    def emit(messages: DataFrame, batch_id: int) -> None:
        messages.select("value").write.format(fmt).mode("overwrite").save(
            f"{path}/batch_id={batch_id}"
        )

    return emit
