"""Message topics as streams: Kafka in production, text files in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wardline.config import StreamConfig


def _placed(raw: DataFrame, config: StreamConfig, fmt: str) -> DataFrame:
    if fmt == "kafka":
        return raw.select(
            F.col("value").cast("string").alias("value"),
            "topic", "partition", "offset", F.col("timestamp").alias("message_time"),
        )
    return raw.select(
        "value",
        F.lit(config.kafka_topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.col("_metadata.file_modification_time").alias("message_time"),
    )


def read_messages(
    spark: SparkSession,
    config: StreamConfig,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
    most_per_batch: int | None = None,
) -> DataFrame:
    """Stream of ``value`` with its topic, partition, offset and time of arrival.

    ``most_per_batch`` bounds a micro-batch, in messages of a topic or else in files;
    the rest follows in later ones.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", config.kafka_bootstrap)
            .option("subscribe", config.kafka_topic)
            .option("groupIdPrefix", config.kafka_group)
            .option("startingOffsets", config.kafka_offset_reset)
        )
    if most_per_batch is not None:
        bound = "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(bound, str(most_per_batch))
    return _placed(reader.options(**(options or {})).load(path), config, fmt)


def read_topic(
    spark: SparkSession,
    config: StreamConfig,
    fmt: str = "kafka",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """What a topic holds now, in the columns of ``read_messages``."""
    reader = spark.read.format(fmt)
    if fmt == "kafka":
        reader = reader.option("kafka.bootstrap.servers", config.kafka_bootstrap).option(
            "subscribe", config.kafka_topic
        )
    return _placed(reader.options(**(options or {})).load(path), config, fmt)


def message_writer(
    messages: DataFrame,
    config: StreamConfig,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataStreamWriter:
    """Append-mode writer of ``(key, value)``; ``.start()`` is left to the caller.

    Any other sink than Kafka gets the message texts alone.
    """
    writer = (
        (messages if fmt == "kafka" else messages.select("value"))
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if fmt == "kafka":
        return writer.option("kafka.bootstrap.servers", config.kafka_bootstrap).option(
            "topic", config.kafka_topic
        )
    return writer.option("path", path)


def echo_lines(messages: DataFrame) -> DataFrame:
    """``source`` (topic/partition/offset) and ``text`` of each consumed message."""
    offset = F.coalesce(F.col("offset").cast("string"), F.lit("?"))
    return messages.select(
        F.concat_ws("/", "topic", F.col("partition").cast("string"), offset).alias("source"),
        F.col("value").alias("text"),
    )


def echo_writer(messages: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Prints consumed messages on the driver; for debugging."""
    return (
        echo_lines(messages)
        .writeStream.format("console")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
