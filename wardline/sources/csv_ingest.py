"""Gzip or plain CSV to typed Parquet.

A ``.gz`` file can only be read front to back, by one task per file. So each
file is unpacked once into an all-text Parquet scratch table; typing and the
final write then run on as many tasks as the data needs. Plain files are cut by
many tasks from the start, quoted line breaks or not.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.parsing import text_integer, text_number, tokens_to_null
from wardline.operators.fingerprint import differing
from wardline.schemas import CSV_NULL_TOKENS, TEXT_NULL_TOKENS
from wardline.session import materialize, scratch_scope
from wardline.sources.csv_split import read_records, records

log = logging.getLogger(__name__)

NUMERIC_SHARE = 0.7
TABLES_AT_ONCE = 4
# Files with these endings are unpacked by Spark, front to back.
PACKED = (".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4", ".xz")
_RAGGED = "_ragged"
_LONG = "_long"

STATUS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("note", T.StringType()),
    ]
)


def read_csv_text(
    spark: SparkSession, path: str, ragged: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Header CSV, plain or gzip, every column as text, null tokens still in place.

    Columns go by the names in each file's own header: files of one header are
    read together, and a column that a file lacks is null in its rows. Reading
    the headers costs a small read of each file. ``ragged`` names an extra
    column that holds the whole line where it has more or fewer fields than the
    header, and null elsewhere. Plain files are split over tasks: they are read
    here and now, twice, and their records stored as a scratch table. Without
    ``multi_line`` a quoted field may not hold a line break, which saves that.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("inferSchema", False)
    )
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        by_header.setdefault(tuple(reader.csv(file).columns), []).append(file)
    out = None
    for header, files in by_header.items():
        names = [*header, *([ragged] if ragged else [])]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        plain = [f for f in files if multi_line and not f.lower().endswith(PACKED)]
        parts = [read_records(records(spark, plain), schema, ragged)] if plain else []
        if others := [f for f in files if f not in set(plain)]:
            part = reader.schema(schema)
            if ragged:
                part = part.option("columnNameOfCorruptRecord", ragged)
            parts.append(part.csv(others))
        for rows in parts:
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return reader.csv(path) if out is None else out


def has_more_fields(line: str, columns: int) -> Column:
    """Whether a ragged line has more than so many fields; empty fields count.

    A mark put behind the line as one more field is then beyond the next column.
    """
    mark = "\x02"
    schema = ", ".join(f"c{i} string" for i in range(columns + 1))
    marked = F.concat(F.col(line), F.lit("," + mark))
    fields = F.from_csv(marked, schema, {"escape": '"', "multiLine": "true"})
    found = [F.coalesce(fields[f"c{i}"] == mark, F.lit(False)) for i in range(columns + 1)]
    return ~F.greatest(F.lit(False), *found)


def normalize_nulls(
    df: DataFrame, tokens: tuple[str, ...] = CSV_NULL_TOKENS + TEXT_NULL_TOKENS
) -> DataFrame:
    """Null tokens to null in all text columns."""
    tokens = tuple(dict.fromkeys(tokens))
    return df.select(
        *[
            tokens_to_null(f"`{f.name}`", tokens).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def infer_types(
    df: DataFrame, keep_string: tuple[str, ...] = (), share: float = NUMERIC_SHARE
) -> dict[str, str]:
    """Column name to ``bigint``, ``double`` or ``string``, in one pass over all rows.

    A text column is numeric if more than ``share`` of all rows, nulls
    included, read as numbers. It is ``bigint`` if every row is a plain integer.
    """
    texts = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in keep_string
    ]
    if not texts:
        return {}
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(texts):
        counts.append(F.count(text_number(f"`{name}`")).alias(f"n{i}"))
        counts.append(F.count(text_integer(f"`{name}`")).alias(f"i{i}"))
    seen = df.agg(*counts).first()
    types = {}
    for i, name in enumerate(texts):
        if seen[f"n{i}"] <= seen["rows"] * share:
            types[name] = "string"
        else:
            types[name] = "bigint" if seen[f"i{i}"] == seen["rows"] else "double"
    return types


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns as inferred; text that is no number becomes null."""
    read = {"bigint": text_integer, "double": text_number}
    return df.select(
        *[
            read[types[c]](f"`{c}`").alias(c) if types.get(c) in read else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def convert_csv(
    spark: SparkSession,
    source: str,
    target: str,
    table: str | None = None,
    keep_string: tuple[str, ...] = (),
    allow_ragged: bool = False,
    multi_line: bool = True,
) -> Row:
    """Convert one CSV table to snappy Parquet and check that no row and no field was lost.

    Returns ``(table, rows_in, rows_out, ok, note)``. Lines with fewer fields
    than the header are filled up with nulls and counted in ``note``. Lines with
    more fields cannot be kept whole: they go, as they are, to the table
    ``target`` + ``_rejects``, and the conversion fails unless ``allow_ragged``.
    """
    with scratch_scope(spark):
        raw = read_csv_text(spark, source, _RAGGED, multi_line)
        width = len(raw.columns) - 1
        unpacked = materialize(raw.withColumn(_LONG, _too_long(raw, width)), "csv")
        seen = unpacked.agg(
            F.count(F.lit(1)).alias("rows"), F.count(_RAGGED).alias("ragged"), F.count_if(_LONG).alias("long")
        ).first()
        unpacked.filter(_LONG).select(F.col(_RAGGED).alias("line")).write.mode("overwrite").parquet(
            f"{target}_rejects"
        )
        text = normalize_nulls(unpacked.filter(~F.col(_LONG)).drop(_RAGGED, _LONG))
        typed = apply_types(text, infer_types(text, keep_string))
        typed.write.option("compression", "snappy").mode("overwrite").parquet(target)
        return verify_copy(
            spark, seen["rows"], target, table or source, seen["ragged"] - seen["long"], seen["long"], allow_ragged, typed
        )


def _too_long(raw: DataFrame, width: int) -> Column:
    long = F.col(_RAGGED).isNotNull() & has_more_fields(_RAGGED, width)
    return F.coalesce(long, F.lit(False))


def verify_copy(
    spark: SparkSession,
    rows_in: int,
    target: str,
    table: str,
    short: int = 0,
    rejected: int = 0,
    allow_ragged: bool = False,
    content: DataFrame | None = None,
) -> Row:
    """Compare the rows that went in with those that can be read back or were rejected.

    ``content`` is what was to be written: its values are compared with those read back, by one aggregation each.
    """
    copy = spark.read.parquet(target)
    rows_out = copy.count()
    lost = rows_in - rows_out - rejected
    notes = [f"{lost} rows lost"] if lost else []
    wrong = [] if content is None else differing(content, copy)
    if wrong:
        notes.append(f"content differs in {', '.join(wrong)}")
    if short:
        notes.append(f"{short} lines with fewer fields than the header")
    if rejected:
        notes.append(f"{rejected} lines with more fields than the header rejected")
    ok = not lost and not wrong and (allow_ragged or not rejected)
    log.info("%s: %d rows in, %d rows out", table, rows_in, rows_out)
    return Row(table=table, rows_in=rows_in, rows_out=rows_out, ok=ok, note="; ".join(notes))


def ingest_tables(
    spark: SparkSession,
    sources: dict[str, str],
    target_base: str,
    keep_string: dict[str, tuple[str, ...]] | None = None,
    at_once: int = TABLES_AT_ONCE,
) -> DataFrame:
    """Convert several tables, one status row each; an input that fails is noted and skipped.

    ``at_once`` tables are worked on side by side, each in a scheduler pool of its own: one that keeps few tasks
    busy (a single gzip file) leaves the rest of the cluster to others. Pools share alike where
    ``spark.scheduler.mode`` is FAIR. Each table has its own scratch tables and its own failure.
    """

    def convert(table: str, source: str) -> Row:
        context = spark.sparkContext
        context.setLocalProperty("spark.scheduler.pool", f"ingest-{table}")
        try:
            return convert_csv(
                spark, source, f"{target_base.rstrip('/')}/{table}.parquet", table, (keep_string or {}).get(table, ())
            )
        except (PySparkException, Py4JJavaError) as error:
            log.warning("%s skipped: %s", table, error)
            note = f"failed: {str(error).splitlines()[0]}"
            return Row(table=table, rows_in=None, rows_out=None, ok=False, note=note)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        # Each call gets the caller's job group and other local properties.
        jobs = [pool.submit(inheritable_thread_target(spark)(convert), *pair) for pair in sources.items()]
        status = [job.result() for job in jobs]
    return spark.createDataFrame([tuple(row) for row in status], STATUS)


def require_complete(status: DataFrame) -> None:
    """Raise if any table failed; the callers of a batch job turn this into its exit code."""
    failed = [r["table"] for r in status.filter(~F.col("ok")).select("table").collect()]
    if failed:
        raise RuntimeError(f"tables not converted: {', '.join(failed)}")
