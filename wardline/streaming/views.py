"""Results that are kept up to date while a stream loads, batch by batch, so that asking for them does not read the table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.streaming.ingest import Sink

BATCH = "batch_id"


def fan_out(*sinks: Sink) -> Sink:
    """One batch to several sinks, in turn. Each has to take a repeated batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(rows, batch_id)

    return write


def _held(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def distinct_sink(path: str, *keys: str) -> Sink:
    """Keeps the distinct values of ``keys``: each value lies in the folder of the batch that brought it first.

    A batch adds the values that no earlier one has, so a repeated batch replaces its own folder by the
    same values, whatever has come since. A batch's rows are made distinct on the map side, so a value that fills
    a third of them costs a row a task, and the values kept are read by their key columns alone.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        fresh = rows.select(*keys).distinct()
        held = _held(rows.sparkSession, path)
        if held is not None:
            earlier = held.where(F.col(BATCH) < batch_id)
            same = [fresh[k].eqNullSafe(earlier[k]) for k in keys]
            fresh = fresh.join(earlier, same, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def distinct_view(spark: SparkSession, path: str) -> DataFrame:
    """The values a ``distinct_sink`` keeps, each once."""
    return spark.read.parquet(path).drop(BATCH)


def maintained_patient_list(spark: SparkSession, path: str) -> DataFrame:
    """``operators.serving.patient_list`` from a view kept on ``subject_id``; the served table is not read."""
    return distinct_view(spark, path).select("subject_id").orderBy("subject_id")
