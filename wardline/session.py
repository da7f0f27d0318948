"""Session builder, shared scratch tables and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Rows the driver hands over carry a default estimate near the largest long.
UNKNOWN_SIZE_BYTES = 1 << 62

# Scratch paths outside any scope, and those of the scope that a thread is in.
_written: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)
_local_root: list[str] = []


def build_session(
    app_name: str = "wardline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A UTC session; sizes stay the cluster's unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def partitions_for(*inputs: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partitions of about ``target_bytes`` for these inputs; 1 where no size is known."""
    total = sum(input_bytes(df) for df in inputs)
    return max(1, -(-total // target_bytes))


@contextmanager
def sized_shuffles(
    spark: SparkSession, *inputs: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES
) -> Iterator[int]:
    """Within the block, the shuffle partition count that jobs over ``inputs`` need, if it is the larger one.

    Adaptive execution merges partitions that turn out small but does not
    split large ones, so a count set too low stays too low. Afterwards the
    session has its own count again; frames have to be stored inside the block.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    count = max(int(before), partitions_for(*inputs, target_bytes=target_bytes))
    spark.conf.set(name, str(count))
    try:
        yield count
    finally:
        spark.conf.set(name, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: a path on one
    machine would lose its data together with an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="wardline-scratch-"))
    return _local_root[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/wardline-{label}-{uuid.uuid4().hex}"
    own = _scope.get()
    (_written if own is None else own).append(path)
    return path


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a scratch Parquet table and read it back.

    Cuts lineage, survives lost executors and, unlike a checkpoint, still lets
    later scans prune columns and row groups. A ``path`` from ``scratch_path``
    outside of a scope outlives the scope.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    released = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        released += bool(path.getFileSystem(conf).delete(path, True))
    return released


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process wrote outside of scopes; call when results are stored."""
    return _delete(spark, _written)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written within the block are deleted at its end; results have to be stored by then.

    A scope belongs to its thread: tables that others write at the same time are not its own.
    """
    own: list[str] = []
    before = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(before)
        _delete(spark, own)


def input_bytes(df: DataFrame) -> int:
    """Size of what ``df`` reads, by the optimizer's figures for its scans.

    Its figure for a join is the product of both sides, useless as a bound, so
    only the leaves count. Leaves without a known size are left out.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < UNKNOWN_SIZE_BYTES)


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, by one aggregate over it."""
    width = F.lit(8)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) + 16
        else:
            width = width + 8
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).cast("long")).first()[0]


def lookup_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark a lookup table for broadcast if its measured size allows that.

    Beyond the limit the table is returned unmarked: the join shuffles on its
    key and adaptive execution splits skewed partitions of the larger side.
    Measuring runs the plan of ``df`` once; it is skipped where the scans alone
    are far above the limit.
    """
    if input_bytes(df) > 16 * limit:
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit else df

