"""Loads a message stream into the serving table, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wardline.config import StreamConfig
from wardline.functions.messages import decode
from wardline.operators.serving import store_served
from wardline.schemas import SERVING

Sink = Callable[[DataFrame, int], None]

PAGE_ROWS = 500
TRIGGER = "2 seconds"
REJECT_COLUMNS = ("message", "reject_reason", "topic", "partition", "offset")


def serving_rows(decoded: DataFrame) -> DataFrame:
    """Sound messages as rows of the serving table, stamped with the loading time."""
    return (
        decoded.filter(F.col("reject_reason").isNull())
        .withColumn("created_at", F.current_timestamp())
        .select(*SERVING.fieldNames())
    )


def rejected_rows(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        *[c for c in REJECT_COLUMNS if c in decoded.columns]
    )


def parquet_sink(path: str) -> Sink:
    """One folder per micro-batch. A repeated batch replaces its own folder."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def day_sink(path: str) -> Sink:
    """Folders by day, so that trailing windows read only their days, and by micro-batch within a day.

    A repeated batch has the same rows, so it replaces its own folders in each day.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumns({"event_date": F.to_date("event_time"), "batch_id": F.lit(batch_id)})
            .sortWithinPartitions("event_date", "subject_id", "event_time")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "batch_id")
            .parquet(path)
        )

    return write


def compact_days(spark: SparkSession, path: str, target: str) -> None:
    """The loaded table again, with few files a day, clustered by patient and time."""
    store_served(spark.read.parquet(path).drop("batch_id", "event_date"), target, "overwrite")


def jdbc_sink(config: StreamConfig, page_rows: int = PAGE_ROWS) -> Sink:
    """Appends to the database table, ``page_rows`` per statement batch.

    Each task commits its rows on its own, so a batch repeated after a failure
    can insert rows again; the table has no key that would prevent it.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.jdbc(
            config.jdbc_url,
            config.pg_table,
            mode="append",
            properties={
                "user": config.pg_user,
                "password": config.pg_password,
                "driver": "org.postgresql.Driver",
                "batchsize": str(page_rows),
            },
        )

    return write


def load_messages(
    messages: DataFrame,
    sink: Sink,
    reject_sink: Sink,
    checkpoint: str,
    trigger: dict | None = None,
) -> DataStreamWriter:
    """Decode each micro-batch; sound rows go to ``sink``, the rest to ``reject_sink``."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        try:
            sink(serving_rows(decoded), batch_id)
            reject_sink(rejected_rows(decoded), batch_id)
        finally:
            decoded.unpersist()

    return (
        messages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
    )


def finish(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for a query to end; stop it and raise if it outlasts ``timeout`` seconds."""
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError(f"stream {query.id} still runs after {timeout} s")
    except (StreamingQueryException, TimeoutError):
        query.stop()
        raise
    return query
