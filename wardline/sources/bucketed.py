"""Tables stored in buckets of the admission, so that counting and joining them needs no shuffle.

Rows are combined per key before they are stored (a count for each admission and drug), so an admission with a
third of all prescriptions takes no more rows than there are drugs and its bucket is like the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from wardline.session import materialize, measured_bytes, partitions_for, scratch_path

BUCKET_BYTES = 128 * 1024 * 1024


def bucket_count(*frames: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` for the largest of these stored tables: a power of two, so that later tables of other sizes fit."""
    need = max(partitions_for(f, target_bytes=bucket_bytes) for f in frames)
    return 1 << (need - 1).bit_length()


def row_bucket_count(*frames: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Like ``bucket_count``, by the measured size of the rows rather than of their compressed files.

    A bucket is read, sorted and combined by one task, which holds its rows as they are, not as they are stored.
    """
    need = max(1, *(-(-measured_bytes(f) // bucket_bytes) for f in frames))
    return 1 << (need - 1).bit_length()


class Buckets(NamedTuple):
    """Tables as read back, by name, and their names in the session's catalog."""

    frames: dict[str, DataFrame]
    tables: dict[str, str]

    def drop(self) -> None:
        """Forget the tables; their files stay where they are."""
        for name, table in self.tables.items():
            self.frames[name].sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def store_bucketed(
    frames: Mapping[str, DataFrame], keys: Sequence[str], root: str | None = None, bucket_bytes: int = BUCKET_BYTES
) -> Buckets:
    """Store tables of one key side by side: the same number of buckets, sorted by the key within each.

    They are external tables over files below ``root`` (the scratch folder unless given). Rows are dealt to their
    bucket before they are written, so a bucket is one file and is read in order.
    """
    spark = next(iter(frames.values())).sparkSession
    root = root or scratch_path(spark, "buckets")
    stored = {name: materialize(df, f"unbucketed-{name}") for name, df in frames.items()}
    n = max(bucket_count(*stored.values(), bucket_bytes=bucket_bytes), row_bucket_count(*stored.values(), bucket_bytes=bucket_bytes))
    out = Buckets({}, {})
    for name, df in stored.items():
        table = f"bucketed_{name}_{uuid.uuid4().hex[:12]}"
        (
            df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
            .option("path", f"{root}/{name}").format("parquet").saveAsTable(table)
        )
        out.frames[name], out.tables[name] = spark.table(table), table
    return out
