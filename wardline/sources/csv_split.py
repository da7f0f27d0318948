"""Records of a plain CSV file, cut by many tasks though quoted fields may hold line breaks.

Spark deals out a file in byte ranges and each task gets the lines that begin in its range. Whether a line begins a record
depends on all quotes before it. So each range is first read on trial under both assumptions, that it begins
within a quoted field or not, and gives the state it ends in for either. Carrying the true state along the ranges of
a file, a row each, tells how every range begins. A second reading then cuts the records; those that reach over a
border of ranges come out in parts, and only the parts are shuffled together.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.session import materialize

# A field from its start: quoted (group 1 holds the closing quote, if there is one) or not, and the rest up to the comma.
_FIELD = re.compile(r'(?:"(?:[^"]|"")*+("?))?+[^,]*+', re.S)
_REST_OF_QUOTED = re.compile(r'(?:[^"]|"")*+("?)[^,]*+', re.S)

_BLOCK = "file bigint, start bigint"


def ends_open(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, if one is (``inside``) or is not at its start.

    Only a quote at the start of a field opens it; doubled quotes within stand for one; what follows the closing
    quote up to the comma belongs to the field.
    """
    at = 0
    if inside:
        rest = _REST_OF_QUOTED.match(line)
        if not rest[1]:
            return True
        at = rest.end() + 1
    while at <= len(line):
        field = _FIELD.match(line, at)
        if field[1] == "":
            return True
        at = field.end() + 1
    return False


# Threads that need files cut alike share the setting; one that needs another waits.
_turn = threading.Condition()
_holders: dict[str, int] = {}
_PARALLEL, _BYTES = "spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes"
_before: dict[str, str | None] = {}


@contextmanager
def fixed_ranges(spark: SparkSession, split_bytes: int | None = None) -> Iterator[None]:
    """Within the block, files are cut at the same places each time, however many executors there are."""
    wanted = str(split_bytes or "")
    with _turn:
        _turn.wait_for(lambda: not _holders or wanted in _holders)
        if not _holders:
            _before.update({name: spark.conf.get(name, None) for name in (_PARALLEL, _BYTES)})
            spark.conf.set(_PARALLEL, "1")
            if wanted:
                spark.conf.set(_BYTES, wanted)
        _holders[wanted] = _holders.get(wanted, 0) + 1
    try:
        yield
    finally:
        with _turn:
            _holders[wanted] -= 1
            if not _holders[wanted]:
                del _holders[wanted]
                for name, value in _before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)
                _turn.notify_all()


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """value, file (a hash of its path) and start (of its range) of each line; a task's rows are in their order in the file."""
    text = spark.read.option("lineSep", "\n").text(files)
    return text.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """A batch cut where the range changes: file, start, rows."""
    file, start = batch.column("file").to_numpy(), batch.column("start").to_numpy()
    borders = [0, *((file[1:] != file[:-1]) | (start[1:] != start[:-1])).nonzero()[0] + 1, len(file)]
    for a, b in zip(borders, borders[1:]):
        if b > a:
            yield int(file[a]), int(start[a]), batch.slice(a, b - a)


def _quoted(batch: pa.RecordBatch) -> Iterator[str]:
    """The lines with a quote; the others leave every state as it is."""
    lines = batch.column("value")
    return lines.filter(pc.match_substring(lines, '"')).to_pylist()


_TRIAL = f"{_BLOCK}, from_out boolean, from_in boolean, closes boolean"


def _trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range its state at the end from either state at the start, and whether an open field is ever closed in it."""
    found: dict[tuple[int, int], list[bool]] = {}
    for batch in batches:
        for file, start, rows in _runs(batch):
            state = found.setdefault((file, start), [False, True, False])
            for line in _quoted(rows):
                same = state[0] == state[1]
                state[0] = ends_open(line, state[0])
                state[1] = state[0] if same else ends_open(line, state[1])
                state[2] = state[2] or not state[1]
    if found:
        yield pa.RecordBatch.from_pydict({
            "file": [k[0] for k in found], "start": [k[1] for k in found],
            "from_out": [v[0] for v in found.values()], "from_in": [v[1] for v in found.values()], "closes": [v[2] for v in found.values()],
        })


def _starts(lines: DataFrame) -> DataFrame:
    """file, start, inside (a quoted field is open at the range's start) and chain (the range in which that field's record began).

    A range either keeps a state, turns it round, or ends in one state whatever it began with. The true state is the last
    such fixed one, turned as often as ranges turn since: sums over the ranges of a file before this one.
    """
    ranges = lines.mapInArrow(_trial, _TRIAL).groupBy("file", "start").agg(
        # A range is read by one task.
        F.first("from_out").alias("from_out"), F.first("from_in").alias("from_in"), F.first("closes").alias("closes")
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("from_out") & ~F.col("from_in")).cast("int")
    counted = ranges.withColumn("turns", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").cast("int").alias("state"), F.col("turns").alias("at")))
    counted = counted.withColumn("last", F.last(fixed, ignorenulls=True).over(before))
    since = F.col("turns") - F.coalesce("last.at", F.lit(0)) + F.coalesce("last.state", F.lit(0))
    known = counted.withColumn("inside", since % 2 == 1)
    opens = F.when(F.col("inside"), F.col("from_in") & F.col("closes")).otherwise(F.col("from_out"))
    chain = F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)
    return known.select("file", "start", "inside", F.when(F.col("inside"), chain).alias("chain"))


_RECORD = f"{_BLOCK}, record string, chain bigint, is_first boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of each range, and with a ``chain`` the parts of those that reach over a border."""
    rows: list[tuple] = []
    held: list[str] = []
    here: tuple[int, int] | None = None
    inside, chain, is_first = False, None, False

    def leave() -> None:
        # What is open at a range's end began in it, or came in and goes on.
        if held:
            rows.append((*here, "\n".join(held), here[1] if chain is None else chain, is_first))
            held.clear()

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = ["file", "start", "record", "chain", "is_first"]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        rows.clear()
        return out

    for batch in batches:
        for file, start, some in _runs(batch):
            if (file, start) != here:
                leave()
                here = (file, start)
                known = some.column("inside")[0].as_py()
                if known is None:
                    raise RuntimeError("a file was cut at other places when it was read again")
                inside, chain, is_first = known, some.column("chain")[0].as_py(), start == 0
            lines = some.column("value")
            for line, quoted in zip(lines.to_pylist(), pc.match_substring(lines, '"').to_pylist()):
                open_after = ends_open(line, inside) if quoted else inside
                if open_after:
                    held.append(line)
                else:
                    if held or inside:
                        held.append(line)
                        line = "\n".join(held)
                        held.clear()
                    rows.append((file, start, line, chain, is_first))
                    chain, is_first = None, False
                inside = open_after
        if rows:
            yield flush()
    leave()
    if rows:
        yield flush()


def records(spark: SparkSession, files: list[str], split_bytes: int | None = None) -> DataFrame:
    """``record`` and ``is_first`` (of its file) of every record of plain CSV files, the line break behind it left out.

    Lines end in LF or CRLF, and empty ones between records are left out. A last record whose quote is never closed reaches to the
    end of its file. The records are stored, and the ranges, a row of some 20 bytes for each ``split_bytes`` of the
    files (the session's setting unless given), are broadcast.
    """
    with fixed_ranges(spark, split_bytes):
        starts = materialize(_starts(_lines(spark, files)), "csv-ranges")
        # The join has to keep the order of the lines: a broadcast, of a bounded table.
        placed = _lines(spark, files).join(F.broadcast(starts), ["file", "start"], "left")
        cut = materialize(placed.select("value", "file", "start", "inside", "chain").mapInArrow(_cut, _RECORD), "csv-records")
    parts = F.array_sort(F.collect_list(F.struct("start", "record")))
    joined = cut.where("chain IS NOT NULL").groupBy("file", "chain").agg(
        F.array_join(parts.getField("record"), "\n").alias("record"), F.max("is_first").alias("is_first")
    )
    whole = cut.where("chain IS NULL").select("record", "is_first").unionByName(joined.select("record", "is_first"))
    return whole.select(F.regexp_replace("record", r"\r\z", "").alias("record"), "is_first").where("record <> ''")


def read_records(rows: DataFrame, schema: T.StructType, ragged: str | None = None) -> DataFrame:
    """The fields of records other than a file's first, which is its header; all columns are text."""
    plain = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields))])
    options = {"escape": '"', "multiLine": "true"}
    if ragged:
        options["columnNameOfCorruptRecord"] = f"c{schema.fieldNames().index(ragged)}"
    ddl = ", ".join(f"{f.name} string" for f in plain.fields)
    parsed = rows.where(~F.col("is_first")).select(F.from_csv("record", ddl, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(schema.fieldNames())])
