"""The newest messages of a topic, without reading the rest of it.

A stored topic is read newest files first: files are known by listing alone, and only those from a cut-off on are
opened. The cut-off is moved back, doubling the number of files, until enough messages stand behind it. A Kafka topic has
offsets instead: each partition is read from its end minus the number wanted.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.config import StreamConfig
from wardline.operators.serving import ARRIVAL, last_messages
from wardline.sources.messages import read_topic

FIRST_FILES = 4

# (partition to first offset, partition to the offset behind the last one)
Offsets = dict[int, tuple[int, int]]


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``modified`` and ``bytes`` of every file below ``path``, from the listing; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def batch_of(path: str | Column = "path") -> Column:
    """The micro-batch in whose folder a file lies, as the batch sinks name them; null elsewhere."""
    number = F.regexp_extract(path, r"/batch_id=(\d+)/[^/]*$", 1)
    return F.nullif(number, F.lit("")).cast("long")


def read_newest(
    files: DataFrame,
    mark: Column,
    rows_of: Callable[[list[str]], DataFrame],
    n: int,
    first: int = FIRST_FILES,
) -> DataFrame | None:
    """Rows of the newest files that together have ``n`` rows or more; of all files if they have fewer; None without files.

    ``mark`` orders files: no row of a file may have arrived before a row of a file with a smaller mark. Files of
    one mark are taken together, so which file of a batch holds a message does not matter. Each step doubles the
    number of marks, so at most twice the rows needed are looked at, plus one step.
    """
    marked = files.select("path", mark.alias("mark")).where("mark IS NOT NULL")
    marks = marked.select("mark").distinct().orderBy(F.desc("mark"))
    while True:
        newest = [r["mark"] for r in marks.limit(first).collect()]
        if not newest:
            return None
        # Only the chosen files' names come to the driver.
        chosen = [r["path"] for r in marked.where(F.col("mark") >= newest[-1]).orderBy("path").collect()]
        rows = rows_of(chosen)
        if len(newest) < first or rows.limit(n).count() >= n:
            return rows
        first *= 2


def tail_offsets(held: Offsets, n: int) -> dict[int, tuple[int, int]]:
    """Of each partition the range of offsets that holds its ``n`` last messages, or all it still has."""
    return {p: (max(begin, end - n), end) for p, (begin, end) in held.items()}


def kafka_tail_options(config: StreamConfig, held: Offsets, n: int) -> dict[str, str]:
    """Reader options for the last ``n`` messages of each partition.

    The last ``n`` of the topic are among them, whatever partition they came by. ``held`` has the first and
    the end offset of each partition, as the broker's admin client tells them.
    """
    ranges = tail_offsets(held, n)
    ends = [{str(p): r[i] for p, r in sorted(ranges.items())} for i in (0, 1)]
    return {
        "startingOffsets": json.dumps({config.kafka_topic: ends[0]}),
        "endingOffsets": json.dumps({config.kafka_topic: ends[1]}),
        "failOnDataLoss": "false",
    }


def topic_tail(
    spark: SparkSession,
    config: StreamConfig,
    n: int,
    fmt: str = "kafka",
    path: str | None = None,
    held: Offsets | None = None,
    decoded: Callable[[DataFrame], DataFrame] = lambda messages: messages,
) -> DataFrame:
    """The part of a topic that holds its ``n`` newest messages, in the columns of ``read_topic`` or those of ``decoded``.

    ``decoded`` may also drop messages: then so much is read that ``n`` are left. A Kafka topic is read by the
    offsets in ``held``, from further back while too few are left; without them it is read as a whole. Files
    are ordered by their time of modification, which is the arrival time of their messages. A topic without files gives no rows.
    """
    if fmt == "kafka":
        if held is None:
            return decoded(read_topic(spark, config))
        reach = n
        while True:
            rows = decoded(read_topic(spark, config, options=kafka_tail_options(config, held, reach)))
            if all(end - begin <= reach for begin, end in held.values()) or rows.limit(n).count() >= n:
                return rows
            reach *= 4
    rows = read_newest(files_of(spark, path), F.col("modified"), lambda some: decoded(read_topic(spark, config, fmt, some)), n)
    return decoded(read_topic(spark, config, fmt, path)).limit(0) if rows is None else rows


def store_batches(messages: DataFrame, path: str, batch: Column) -> None:
    """Append messages to a stored topic, a folder for each micro-batch, ordered by arrival within a file."""
    order = [c for c in ARRIVAL if c in messages.columns]
    stored = messages.withColumn("batch_id", batch.cast("long"))
    stored.repartitionByRange("batch_id", *order).sortWithinPartitions("batch_id", *order).write.mode("append").partitionBy("batch_id").parquet(path)


def last_stored(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """The ``n`` messages that arrived last in a topic stored by micro-batch, newest first; older batches are not read.

    A batch is taken to have arrived after all batches of smaller numbers.
    """

    def rows_of(some: list[str]) -> DataFrame:
        return spark.read.option("basePath", path).parquet(*some)

    newest = read_newest(files_of(spark, path), batch_of(), rows_of, n)
    if newest is None:
        return spark.read.parquet(path).limit(0)
    columns = [c for c in ARRIVAL if c in newest.columns]
    return last_messages(newest, ("batch_id", *columns), n).drop("batch_id") if "batch_id" in newest.columns else last_messages(newest, tuple(columns), n)
