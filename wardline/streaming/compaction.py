"""Incremental compaction of a table that a stream loads day by day.

The stream appends folders ``event_date=D/batch_id=N`` (see ``ingest.day_sink``). A manifest beside the table names the compacted folder of
each day and the last batch that has gone into them. What is live: the compacted folders of the newest manifest, and
all batches behind its last one. Compacting rewrites the days that have new batches, into folders of their own, and then
puts a new manifest in place by one rename. Whatever happens before the rename leaves the former state, and folders no
manifest names; whatever happens after it leaves the new state, and folders that are read no more.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import partitions_for

DATE, BATCH, RUN = "event_date", "batch_id", "run"
_NAME = re.compile(r"manifest-(\d+)\.json")


@dataclass(frozen=True)
class Manifest:
    """``days``: event date to the run that compacted it; a row for each day, whatever the size of the table."""

    version: int = 0
    upto: int = -1
    days: dict[str, str] = field(default_factory=dict)


class CompactedTable:
    """A table loaded by ``day_sink`` at ``path``, its compacted days in ``path`` + ``_compacted``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.compacted = f"{self.path}_compacted"
        self._manifests = f"{self.compacted}/_manifests"

    def _at(self, path: str) -> tuple[JavaObject, JavaObject]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        fs, place = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def manifest(self) -> Manifest:
        """The newest manifest; an empty one before the first compaction."""
        versions = [int(m[1]) for m in map(_NAME.fullmatch, self._names(self._manifests)) if m]
        if not versions:
            return Manifest()
        fs, place = self._at(f"{self._manifests}/manifest-{max(versions)}.json")
        stream = fs.open(place)
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _batches(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _days(self, days: dict[str, str]) -> DataFrame | None:
        folders = [f"{self.compacted}/{RUN}={run}/{DATE}={day}" for day, run in sorted(days.items())]
        return self.spark.read.option("basePath", self.compacted).parquet(*folders).drop(RUN) if folders else None

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """All live rows, with ``event_date`` and without the batch."""
        manifest = manifest or self.manifest()
        loose = self._batches().where(F.col(BATCH) > manifest.upto).drop(BATCH)
        days = self._days(manifest.days)
        return loose if days is None else loose.unionByName(days.select(*loose.columns))

    def compact(self, upto: int | None = None) -> Manifest:
        """Put the batches up to ``upto`` into the compacted folders of their days; returns the manifest that holds now.

        Unless given, ``upto`` is the batch before the newest: a stream that starts again repeats no other than
        its last one. Rows of a day are stored by patient and time, in files that a task can hold.
        """
        now = self.manifest()
        if upto is None:
            newest = self._batches().agg(F.max(BATCH)).first()[0]
            upto = -1 if newest is None else newest - 1
        fresh = self._batches().where((F.col(BATCH) > now.upto) & (F.col(BATCH) <= upto))
        # One row a day.
        changed = [str(r[DATE]) for r in fresh.select(DATE).distinct().collect()]
        if not changed:
            return now
        rows = fresh.drop(BATCH)
        before = self._days({d: run for d, run in now.days.items() if d in set(changed)})
        if before is not None:
            rows = rows.unionByName(before.select(*rows.columns))
        run = uuid.uuid4().hex
        cluster = [DATE, "subject_id", "event_time"]
        parts = partitions_for(rows)
        (
            rows.repartitionByRange(parts, *cluster).sortWithinPartitions(*cluster)
            .write.partitionBy(DATE).parquet(f"{self.compacted}/{RUN}={run}")
        )
        return self._publish(Manifest(now.version + 1, upto, now.days | dict.fromkeys(changed, run)))

    def _publish(self, manifest: Manifest) -> Manifest:
        """Write the manifest under a name of its own and rename it; the name of a version can be taken once only."""
        final = f"{self._manifests}/manifest-{manifest.version}.json"
        fs, draft = self._at(f"{self._manifests}/_draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest.__dict__).encode()))
        finally:
            stream.close()
        place = self._at(final)[1]
        if fs.exists(place) or not fs.rename(draft, place):
            fs.delete(draft, False)
            raise RuntimeError(f"version {manifest.version} of the table was published by another compaction")
        return manifest

    def clean(self) -> int:
        """Delete what the newest manifest does not need: absorbed batches, replaced runs, old manifests. Returns the number of folders.

        To be called when no reader is left that started before the last compaction.
        """
        manifest, gone = self.manifest(), 0

        def delete(path: str) -> int:
            fs, place = self._at(path)
            return int(fs.delete(place, True))

        for day in self._names(self.path):
            if day.startswith(f"{DATE}="):
                for batch in self._names(f"{self.path}/{day}"):
                    if batch.startswith(f"{BATCH}=") and int(batch.split("=")[1]) <= manifest.upto:
                        gone += delete(f"{self.path}/{day}/{batch}")
        live = {(run, f"{DATE}={day}") for day, run in manifest.days.items()}
        for run in self._names(self.compacted):
            if run.startswith(f"{RUN}="):
                days = [d for d in self._names(f"{self.compacted}/{run}") if d.startswith(f"{DATE}=")]
                dead = [d for d in days if (run.split("=")[1], d) not in live]
                if len(dead) == len(days):
                    gone += delete(f"{self.compacted}/{run}")
                else:
                    gone += sum(delete(f"{self.compacted}/{run}/{d}") for d in dead)
        for name in self._names(self._manifests):
            if name != f"manifest-{manifest.version}.json":
                delete(f"{self._manifests}/{name}")
        return gone
