"""Whole jobs over the clinical tables: ingest, features, recommendation, replay, loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wardline.config import StreamConfig
from wardline.operators import features as ft
from wardline.operators import meds, quality, recommend, report, serving, vitals
from wardline.plans import flows
from wardline.schemas import VITAL_BANDS
from wardline.session import sized_shuffles
from wardline.sources.csv_ingest import ingest_tables, require_complete
from wardline.functions.messages import decode
from wardline.sources import tail
from wardline.sources.messages import read_messages
from wardline.sources.tables import read_table, read_tables
from wardline.streaming import ingest, replay

FEATURE_TABLES = ("chartevents", "prescriptions", "icustays")


def ingest_job(
    spark: SparkSession,
    sources: dict[str, str],
    target_base: str,
    keep_string: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Convert gzip CSV tables to Parquet; raises after the last if any failed."""
    status = ingest_tables(spark, sources, target_base, keep_string)
    require_complete(status)
    return status


def feature_job(
    spark: SparkSession,
    base: str,
    out: str,
    vocabulary_size: int = 30,
    min_stays: int = 5,
    validate: bool = True,
) -> flows.FeatureTables:
    """Readings and prescriptions to stored features, vectors and report.

    Writes ``features`` (with both vectors), ``stay_drugs``, ``vocabulary``,
    ``drug_statistics`` and ``report`` below ``out``. ``validate`` counts the nulls
    of every column of the tables and of the joined frames, a scan of each.
    """
    tables = read_tables(spark, base, FEATURE_TABLES)
    with sized_shuffles(spark, *tables.values()):
        return _feature_job(spark, tables, out, vocabulary_size, min_stays, validate)


def _feature_job(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    vocabulary_size: int,
    min_stays: int,
    validate: bool,
) -> flows.FeatureTables:
    def checked(df: DataFrame, name: str) -> DataFrame:
        if validate:
            quality.validate(df, name)
        return df

    for name, table in tables.items():
        checked(table, name)

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    drugs = checked(
        store(meds.stay_drugs(tables["prescriptions"], tables["icustays"]), "stay_drugs"), "stay drugs"
    )
    built = flows.FeatureTables(
        checked(store(flows.dataset(tables["chartevents"], drugs), "stay_features"), "stay features"), drugs
    )
    quality.require_rows(built.features, "feature table")
    listed = ft.medication_list(drugs, built.features)
    vocab = store(ft.vocabulary(listed, vocabulary_size, min_stays), "vocabulary")
    terms = ft.vocabulary_terms(vocab)
    vectors = store(ft.vectorize(built.features, drugs, terms), "features")
    store(report.schema_report(vectors), "schema")
    store(meds.top_drugs(meds.drug_statistics(drugs)), "drug_statistics")
    store(
        report.analysis_report(
            built.features, vectors, drugs, len(terms), min_stays=min_stays
        ),
        "report",
    )
    return built


def signal_job(spark: SparkSession, base: str, out: str, row_id: str | None = None) -> DataFrame:
    """Stores the abnormal readings per stay as bounded lists."""
    charts = read_table(spark, base, "chartevents")
    with sized_shuffles(spark, charts):
        vitals.signal_segments(vitals.abnormal_charts(charts), row_id).write.mode(
            "overwrite"
        ).parquet(out)
    return spark.read.parquet(out)


def recommendation_job(spark: SparkSession, base: str, out: str, k: int = 5) -> DataFrame:
    """Stores the ``k`` most frequent medications per diagnosis, with titles; returns the summary."""
    diagnoses = read_table(spark, base, "diagnoses_icd")
    prescriptions = read_table(spark, base, "prescriptions")
    titles = read_table(spark, base, "d_icd_diagnoses")
    with sized_shuffles(spark, diagnoses, prescriptions):
        best = recommend.recommendations(recommend.co_occurrence(diagnoses, prescriptions), k)
        recommend.with_titles(best, titles).write.mode("overwrite").parquet(out)
    return recommend.recommendation_summary(spark.read.parquet(out))


def replay_job(
    spark: SparkSession,
    config: StreamConfig,
    checkpoint: str,
    subject_id: int | str | None = None,
    ticks: DataFrame | None = None,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataStreamWriter:
    """Replays the history of one patient, or of all, as messages.

    The history stays on disk, whatever its size, and each micro-batch reads
    the part it replays. A batch sent to files has a folder of its own.
    """
    charts = read_table(spark, config.tables, "chartevents")
    history = replay.store_history(replay.replay_history(charts, subject_id, VITAL_BANDS))
    length = history.count()
    ticks = replay.clock(spark, config.rows_per_second) if ticks is None else ticks
    emit = replay.kafka_emit(config) if fmt == "kafka" else replay.file_emit(fmt, path)
    return replay.replay_writer(ticks, history, length, emit, checkpoint)


def load_job(
    spark: SparkSession,
    config: StreamConfig,
    checkpoint: str,
    sink: ingest.Sink,
    reject_sink: ingest.Sink,
    fmt: str = "kafka",
    path: str | None = None,
    trigger: dict | None = None,
) -> DataStreamWriter:
    """Loads the topic into the serving table; see ``parquet_sink`` and ``jdbc_sink``."""
    return ingest.load_messages(
        read_messages(spark, config, fmt, path), sink, reject_sink, checkpoint, trigger
    )


def panel_job(
    spark: SparkSession,
    config: StreamConfig,
    fmt: str = "kafka",
    path: str | None = None,
    n: int = 100,
    held: tail.Offsets | None = None,
) -> DataFrame:
    """The panel's last values among the ``n`` sound messages of the topic that arrived last.

    Only the newest part of the topic is read; of a Kafka topic that needs the offsets its partitions hold.
    """

    def sound(messages: DataFrame) -> DataFrame:
        return decode(messages).filter("reject_reason IS NULL").select(
            F.col("event_time").alias("time"), "message_time", "partition", "offset", "itemid",
            F.col("valuenum").alias("value"),
        )

    newest = tail.topic_tail(spark, config, n, fmt, path, held, sound)
    return serving.panel_values(serving.last_messages(newest, n=n), n=n)
