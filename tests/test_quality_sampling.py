import os

import pytest
from helpers import plan, rows

from wardline import session
from wardline.operators import quality, sampling
from wardline.session import (
    input_bytes, lookup_side, materialize, measured_bytes, partitions_for, release_scratch, scratch_root,
    scratch_scope, sized_shuffles,
)
from wardline.sources.tables import select_existing, spread_by_stay


def test_null_profile_in_one_job(spark):
    frame = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows(quality.null_profile(frame, "t")) == [
        ("t", "a", 3, 1, 1 / 3), ("t", "b", 3, 2, 2 / 3),
    ]
    assert rows(quality.columns_with_nulls(frame.select("b"), "t"), "column_name") == [("b",)]


def test_empty_frames_are_refused(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(ValueError):
        quality.validate(empty, "t")
    with pytest.raises(ValueError):
        quality.require_rows(empty, "t")
    full = spark.createDataFrame([(1,)], "a int")
    assert quality.validate(full, "t") == 1 and quality.require_rows(full, "t") is full
    assert quality.null_profile(empty, "t").first()["null_rate"] is None


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "p int")
    assert rows(quality.orphan_report(child, parent, "k", "p", "r")) == [("r", 4, 1, 1)]


def test_duplicates_keep_the_first(spark):
    frame = spark.createDataFrame([(1, "b", 5), (1, "a", 2), (2, "c", 9)], "k int, v string, o int")
    assert rows(sampling.drop_duplicates_first(frame, ["k"], "o")) == [(1, "a", 2), (2, "c", 9)]


def test_key_sample_takes_whole_keys(spark):
    frame = spark.range(20_000).selectExpr("id % 2000 AS k", "id")
    sample = sampling.sample_keys(frame, "k")
    per_key = {r["k"]: r["count"] for r in sample.groupBy("k").count().collect()}
    assert 120 < len(per_key) < 280 and set(per_key.values()) == {10}
    assert 1_500 < sampling.sample_fraction(frame).count() < 2_500


def test_lookup_side_is_measured(spark):
    small = spark.createDataFrame([(1, "x")], "k int, v string")
    big = spark.createDataFrame([(1,)], "k int")
    assert "BroadcastHashJoin" in plan(big.join(lookup_side(small), "k"))
    assert measured_bytes(small) == 8 + 8 + 1 + 16
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(big.join(lookup_side(small, limit=10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scratch_tables_live_in_the_checkpoint_folder(spark):
    stored = materialize(spark.range(10), "t")
    assert stored.count() == 10
    assert all(scratch_root(spark) in f for f in stored.inputFiles())


def test_shuffle_partitions_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = spark.range(10_000)
    unknown = spark.createDataFrame([(1,)], "a int")
    assert partitions_for(frame, target_bytes=1_000) == 80
    assert partitions_for(frame, target_bytes=1) == 80_000
    assert partitions_for(unknown) == 1
    assert input_bytes(frame.join(frame.withColumnRenamed("id", "other"))) == 2 * input_bytes(frame)
    with sized_shuffles(spark, frame) as count:
        assert count == int(before)
    with sized_shuffles(spark, frame, target_bytes=1_000) as count:
        assert count == 80 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_partitions_have_no_upper_bound(spark, monkeypatch):
    monkeypatch.setattr(session, "input_bytes", lambda df: 100 * 2**40)
    assert partitions_for(spark.range(1)) == 409_600


def test_scratch_scope_deletes_what_it_wrote(spark):
    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        gone = materialize(spark.range(3), "gone").inputFiles()
    assert kept.count() == 3 and not os.path.exists(gone[0].removeprefix("file://"))


def test_spread_and_select(spark):
    frame = spark.range(1_000).selectExpr("1 AS stay_id", "id")
    assert select_existing(frame, ["id", "missing", "stay_id"]).columns == ["id", "stay_id"]
    sizes = [len(p) for p in spread_by_stay(frame, 8, salts=16).rdd.glom().collect()]
    assert sum(sizes) == 1_000 and max(sizes) < 600
    assert spread_by_stay(frame, 5).rdd.getNumPartitions() == 5


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_only_a_local_session_falls_back_to_its_own_folder():
    assert scratch_root(Settings(**{"spark.checkpoint.dir": "/shared/cp/"})) == "/shared/cp"
    local = Settings(**{"spark.master": "local[2]"})
    assert scratch_root(local) == scratch_root(local)
    with pytest.raises(RuntimeError):
        scratch_root(Settings(**{"spark.master": "yarn"}))


def test_scratch_tables_are_released(spark):
    kept = session._written[:]
    session._written.clear()
    path = materialize(spark.range(3), "t").inputFiles()[0]
    assert release_scratch(spark) == 1
    assert session._written == []
    session._written.extend(kept)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
