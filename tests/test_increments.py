"""Work in proportion to what is new: tail reads, file ranges, content checks, compaction, kept views, buckets, tables side by side."""

import datetime as dt
import gzip
import json
import random
import threading

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline import session
from wardline.config import StreamConfig
from wardline.operators import fingerprint, meds, recommend, serving
from wardline.plans import catalog, jobs, stand_in
from wardline.sources import bucketed, csv_ingest, csv_split, tail
from wardline.streaming import ingest, views
from wardline.streaming.compaction import CompactedTable


# --- tail of a topic ---


def stored_topic(spark, folder, n, per_batch):
    """``n`` messages in batches; within a batch they arrive in any order of files."""
    messages = spark.range(n).select(
        (F.lit(0).cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("message_time"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.col("id").cast("string").alias("value"),
    )
    tail.store_batches(messages, folder, F.expr(f"offset div {per_batch}"))
    return spark.read.parquet(folder)


@pytest.mark.parametrize("n, wanted", [(1000, 100), (1000, 15), (40, 100), (1000, 1000)])
def test_last_stored_equals_sorting_the_whole_topic(spark, fresh_dir, n, wanted):
    whole = stored_topic(spark, f"{fresh_dir}/topic", n, 10)
    got = tail.last_stored(spark, f"{fresh_dir}/topic", wanted)
    assert [r.offset for r in got.collect()] == [r.offset for r in serving.last_messages(whole, n=wanted).collect()]
    assert "batch_id" not in got.columns


def test_only_the_newest_files_are_opened(spark, fresh_dir):
    whole = stored_topic(spark, f"{fresh_dir}/topic", 1000, 10)
    got = tail.last_stored(spark, f"{fresh_dir}/topic", 30)
    assert got.count() == 30
    opened = {f.split("batch_id=")[1].split("/")[0] for f in got.inputFiles()}
    assert opened == {"96", "97", "98", "99"} and len(whole.inputFiles()) >= 100


def message(i, value=80.0):
    return json.dumps({"subject_id": "1", "itemid": "220045", "valuenum": value, "event_time": f"2150-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}.000Z"})


def topic_of_files(folder, lines_of):
    """Text files with times of modification in their order."""
    import os

    os.mkdir(folder)
    for k, lines in enumerate(lines_of):
        with open(f"{folder}/{k:03d}.txt", "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(f"{folder}/{k:03d}.txt", (1_000 + k, 1_000 + k))


def test_unsound_messages_move_the_cut_off_back(spark, fresh_dir):
    """The newest files hold nothing but rejects."""
    sound = [[message(10 * k + i, float(k)) for i in range(10)] for k in range(30)]
    topic_of_files(f"{fresh_dir}/topic", [*sound, *[["broken"] * 10] * 9])
    decoded = jobs.decode
    rows_of = lambda m: decoded(m).where("reject_reason IS NULL")
    got = tail.topic_tail(spark, StreamConfig(), 25, "text", f"{fresh_dir}/topic", decoded=rows_of)
    assert 25 <= got.count() < 300 and len(got.inputFiles()) < 39
    panel = jobs.panel_job(spark, StreamConfig(), "text", f"{fresh_dir}/topic", n=25)
    assert rows(panel, "itemid", "value") == [("220045", 29.0)]


def test_panel_of_a_topic_without_files(spark, fresh_dir):
    topic_of_files(f"{fresh_dir}/topic", [])
    spark.createDataFrame([], "value string").write.mode("overwrite").text(f"{fresh_dir}/topic")
    assert jobs.panel_job(spark, StreamConfig(), "text", f"{fresh_dir}/topic").collect() == []


def test_kafka_ranges():
    held = {0: (0, 1_000), 1: (990, 1_000), 2: (5, 5)}
    assert tail.tail_offsets(held, 100) == {0: (900, 1_000), 1: (990, 1_000), 2: (5, 5)}
    options = tail.kafka_tail_options(StreamConfig(kafka_topic="t"), held, 100)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 900, "1": 990, "2": 5}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 1_000, "1": 1_000, "2": 5}}


def test_kafka_tail_reaches_further_back_while_messages_are_unsound(spark, monkeypatch):
    asked = []

    def read(spark, config, options):
        start = json.loads(options["startingOffsets"])["chartevents_stream"]["0"]
        asked.append(start)
        return spark.range(start, 1_000).where("id < 970").withColumnRenamed("id", "offset")

    monkeypatch.setattr(tail, "read_topic", read)
    assert tail.topic_tail(spark, StreamConfig(), 10, held={0: (0, 1_000)}).count() >= 10
    assert asked == [990, 960]
    asked.clear()
    assert tail.topic_tail(spark, StreamConfig(), 100_000, held={0: (0, 1_000)}).count() == 970 and asked == [0]


# --- ranges of a CSV file ---


@pytest.mark.parametrize(
    "line, out, inside",
    [
        ("a,b", False, True), ('"a,b', True, False), ('a"b,c', False, False), ('"a""b",c', False, False), ('x,"y', True, False),
        ('"a"x,"b', True, True), ("", False, True), ('"', True, False), ('""', False, True), ('b",c', False, False), ('b"",c', False, True),
        ('",",', False, True), (',"', True, False),
    ],
)
def test_states_of_a_line(line, out, inside):
    assert csv_split.ends_open(line, False) is out
    assert csv_split.ends_open(line, True) is inside


def csv_field(draw):
    kind = draw.randrange(8)
    text = "".join(draw.choice(["a", "b", "é", ",", "\n", '"', " ", "\r\n", "1"]) for _ in range(draw.randrange(12)))
    if kind < 4:
        return '"' + text.replace('"', '""') + '"'
    plain = text.replace(",", "").replace("\n", "").replace("\r", "").lstrip('"')
    # A quote within an unquoted field stands for itself.
    return "x" + plain if kind == 4 else plain.replace('"', "")


@pytest.mark.parametrize("seed, size", [(1, 7), (2, 16), (3, 61), (4, 1 << 20)])
def test_ranges_equal_the_one_task_reading(spark, fresh_dir, seed, size):
    """Borders anywhere, in fields with line breaks and of several ranges too."""
    draw = random.Random(seed)
    lines = ["h1,h2,h3"] + [",".join([f"r{i}", csv_field(draw), csv_field(draw)]) for i in range(120)]
    with open(f"{fresh_dir}/t.csv", "w", newline="", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("h1", "h2", "h3", "_ragged")])
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    wanted = reader.schema(schema).option("columnNameOfCorruptRecord", "_ragged").csv(f"{fresh_dir}/t.csv")
    found = csv_split.records(spark, [f"{fresh_dir}/t.csv"], size)
    got = csv_split.read_records(found, schema, "_ragged")
    assert rows(got, "h1", "h2", "h3") == rows(wanted, "h1", "h2", "h3")
    assert got.count() == 120


def test_a_large_plain_file_is_cut_by_many_tasks(spark, fresh_dir):
    text = "a,b\n" + "".join(f'{i},"line {i}\nof ""two"", or so"\n' for i in range(5_000))
    with open(f"{fresh_dir}/big.csv", "w") as out:
        out.write(text)
    with csv_split.fixed_ranges(spark, 4_096):
        parts = csv_split._lines(spark, [f"{fresh_dir}/big.csv"]).select(F.spark_partition_id(), "start").distinct().collect()
    assert len(parts) > 30 and len({p[0] for p in parts}) > 8
    status = csv_ingest.convert_csv(spark, f"{fresh_dir}/big.csv", f"{fresh_dir}/out")
    assert (status["rows_in"], status["rows_out"], status["ok"]) == (5_000, 5_000, True)
    assert spark.read.parquet(f"{fresh_dir}/out").where("a = 7").first()["b"] == 'line 7\nof "two", or so'


def test_records_of_odd_files(spark, fresh_dir):
    files = {"crlf": 'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', "open": 'a,b\n1,"x\ny,z', "header": '"a\nA",b\n1,2\n', "empty": "", "bare": "a,b"}
    for name, text in files.items():
        with open(f"{fresh_dir}/{name}.csv", "w", newline="") as out:
            out.write(text)
    got = {}
    for name in files:
        found = csv_split.records(spark, [f"{fresh_dir}/{name}.csv"], 5)
        got[name] = sorted((r.record, r.is_first) for r in found.collect())
    assert got["crlf"] == [('1,"x\r\ny"', False), ("2,z", False), ("a,b", True)]
    assert got["open"] == [('1,"x\ny,z', False), ("a,b", True)]
    assert got["header"] == [('"a\nA",b', True), ("1,2", False)]
    assert got["empty"] == [] and got["bare"] == [("a,b", True)]


def test_plain_and_packed_files_of_one_table(spark, fresh_dir):
    import os

    os.mkdir(f"{fresh_dir}/in")
    with open(f"{fresh_dir}/in/one.csv", "w") as out:
        out.write('x,y\n1,"a\nb"\n2\n3,c,d\n')
    with gzip.open(f"{fresh_dir}/in/two.csv.gz", "wt") as out:
        out.write("y,x\ne,4\n")
    status = csv_ingest.convert_csv(spark, f"{fresh_dir}/in", f"{fresh_dir}/out", allow_ragged=True)
    assert (status["rows_in"], status["rows_out"], status["ok"]) == (4, 3, True)
    assert rows(spark.read.parquet(f"{fresh_dir}/out"), "x", "y") == [(1, "a\nb"), (2, None), (4, "e")]
    assert rows(spark.read.parquet(f"{fresh_dir}/out_rejects")) == [("3,c,d",)]


def test_threads_share_a_setting_or_wait(spark):
    name, seen = csv_split._BYTES, []
    before = spark.conf.get(name)

    def use(size, ready, go):
        with csv_split.fixed_ranges(spark, size):
            ready.set()
            go.wait(10)
            seen.append((size, spark.conf.get(name)))

    flags = [(threading.Event(), threading.Event()) for _ in range(3)]
    threads = [threading.Thread(target=use, args=(size, *f)) for size, f in zip((100, 100, 200), flags)]
    for t, f in zip(threads[:2], flags):
        t.start()
        assert f[0].wait(10)
    threads[2].start()
    assert not flags[2][0].wait(0.3)
    for f in flags:
        f[1].set()
    for t in threads:
        t.join(10)
    assert sorted(seen) == [(100, "100"), (100, "100"), (200, "200")] and spark.conf.get(name) == before


# --- content ---


def test_content_checks(spark):
    base = [(1, "a", [1, None], {"k": 1}), (2, "b", None, None), (2, "b", None, None), (None, None, [], {})]
    names = "n int, s string, l array<int>, m map<string,int>"

    def differs(other):
        return fingerprint.differing(spark.createDataFrame(base, names), spark.createDataFrame(other, names))

    assert differs(base[::-1]) == []
    # Values swapped between rows: every column is the same multiset.
    assert differs([(2, "a", [1, None], {"k": 1}), (1, "b", None, None), *base[2:]]) == [fingerprint.ROWS]
    # One row doubled, another lost.
    assert differs([base[0], base[0], base[1], base[3]]) == [fingerprint.ROWS, "l", "m", "n", "s"]
    assert differs([(1, "a", [None, 1], {"k": 1}), *base[1:]]) == [fingerprint.ROWS, "l"]
    assert differs([(1, None, [1, None], {"k": 1}), *base[1:]]) == [fingerprint.ROWS, "s"]
    assert fingerprint.differing(spark.createDataFrame(base, names), spark.createDataFrame(base, names).drop("m")) == [fingerprint.ROWS, "m"]
    assert fingerprint.differing(spark.createDataFrame([], names), spark.createDataFrame([], names)) == []


def test_a_wrong_copy_is_noticed(spark, fresh_dir):
    right = spark.range(100).selectExpr("id", "id % 7 AS k")
    right.selectExpr("id", "CASE WHEN id = 3 THEN 4 WHEN id = 4 THEN 3 ELSE k END AS k").write.parquet(f"{fresh_dir}/swapped")
    status = csv_ingest.verify_copy(spark, 100, f"{fresh_dir}/swapped", "t", content=right)
    assert not status["ok"] and status["note"] == "content differs in (rows)"
    right.where("id <> 5").union(right.where("id = 6")).write.parquet(f"{fresh_dir}/doubled")
    status = csv_ingest.verify_copy(spark, 100, f"{fresh_dir}/doubled", "t", content=right)
    assert not status["ok"] and status["note"] == "content differs in (rows), id, k"
    right.repartition(3).write.parquet(f"{fresh_dir}/right")
    assert csv_ingest.verify_copy(spark, 100, f"{fresh_dir}/right", "t", content=right)["ok"]


# --- compaction ---

DAYS = [dt.date(2150, 1, d) for d in (1, 2, 3)]


def served_rows(spark, *entries):
    """(day, patient) rows with the columns that storing looks at."""
    made = [(f"{p}", dt.datetime.combine(DAYS[d], dt.time(i % 24))) for i, (d, p) in enumerate(entries)]
    return spark.createDataFrame(made, "subject_id string, event_time timestamp")


def load(spark, path, *batches):
    sink = ingest.day_sink(path)
    for batch_id, entries in batches:
        sink(served_rows(spark, *entries), batch_id)


def content(df):
    return rows(df, "subject_id", "event_time", F.col("event_date").cast("string"))


def test_unchanged_days_keep_their_files(spark, fresh_dir):
    path = f"{fresh_dir}/served"
    load(spark, path, (0, [(0, 1), (1, 1)]), (1, [(0, 2), (1, 3), (1, 1)]), (2, [(1, 4)]), (3, [(2, 5)]))
    whole = content(spark.read.parquet(path))
    table = CompactedTable(spark, path)
    assert table.manifest().version == 0 and content(table.read()) == whole
    first = table.compact(upto=1)
    assert set(first.days) == {"2150-01-01", "2150-01-02"} and content(table.read()) == whole
    files = {f for f in table.read().inputFiles() if "2150-01-01" in f}
    # Without a bound the newest batch stays out: the stream may repeat it.
    second = table.compact()
    assert (second.version, second.upto) == (2, 2)
    assert second.days["2150-01-01"] == first.days["2150-01-01"] and second.days["2150-01-02"] != first.days["2150-01-02"]
    assert {f for f in table.read().inputFiles() if "2150-01-01" in f} == files and content(table.read()) == whole
    assert table.compact() == second
    assert table.clean() == 6 and content(table.read()) == whole
    # The loose batch comes again, as after a failure of the stream.
    load(spark, path, (3, [(2, 5)]), (4, [(0, 9)]))
    assert table.read().count() == len(whole) + 1
    assert table.compact().days.keys() == {"2150-01-01", "2150-01-02", "2150-01-03"} and table.read().count() == len(whole) + 1


@pytest.mark.parametrize("step", ["before the manifest", "before the rename", "after the rename"])
def test_a_crash_loses_and_doubles_nothing(spark, fresh_dir, monkeypatch, step):
    path = f"{fresh_dir}/served"
    load(spark, path, *[(b, [(b % 3, p) for p in range(4)]) for b in range(5)])
    whole = content(spark.read.parquet(path))
    table = CompactedTable(spark, path)
    table.compact(upto=1)
    publish = table._publish

    def fails(manifest):
        if step == "after the rename":
            publish(manifest)
        if step == "before the rename":
            fs, draft = table._at(f"{table._manifests}/_draft-x")
            fs.create(draft, False).close()
        raise KeyboardInterrupt

    monkeypatch.setattr(table, "_publish", fails)
    with pytest.raises(KeyboardInterrupt):
        table.compact()
    again = CompactedTable(spark, path)
    assert content(again.read()) == whole
    again.compact()
    assert content(again.read()) == whole
    again.clean()
    assert content(again.read()) == whole and again.manifest().upto == 3


def test_two_compactions_cannot_publish_one_version(spark, fresh_dir):
    path = f"{fresh_dir}/served"
    load(spark, path, (0, [(0, 1)]), (1, [(0, 2)]))
    table = CompactedTable(spark, path)
    first = table.compact()
    with pytest.raises(RuntimeError, match="another compaction"):
        table._publish(first)
    assert table.manifest() == first


# --- kept views ---


def test_patients_are_kept_batch_by_batch(spark, fresh_dir):
    table, view = f"{fresh_dir}/served", f"{fresh_dir}/patients"
    sink = views.fan_out(ingest.parquet_sink(table), views.distinct_sink(view, "subject_id"))
    batches = [["a", "b", "a"], ["b", "c", None], [], ["d", "a"]]
    for batch_id, patients in enumerate(batches):
        rows_of = spark.createDataFrame([(p,) for p in patients], "subject_id string")
        for _ in range(2 if batch_id in (1, 3) else 1):
            sink(rows_of, batch_id)
    # An earlier batch repeated after later ones changes nothing either.
    sink(spark.createDataFrame([("a",), ("b",), ("a",)], "subject_id string"), 0)
    wanted = serving.patient_list(spark.read.parquet(table))
    kept = views.maintained_patient_list(spark, view)
    assert [r[0] for r in kept.collect()] == [r[0] for r in wanted.collect()] == [None, "a", "b", "c", "d"]
    assert all("/patients/" in f for f in kept.inputFiles())


# --- buckets ---


def joined_without_exchange(df):
    text = plan(df)
    below = text[text.index("SortMergeJoin") :]
    return "Exchange" not in below


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_meet_without_a_shuffle(spark, sf, no_broadcast):
    assert joined_without_exchange(catalog.QUERIES["bucketed_prescribed_drugs"](spark, sf))
    assert joined_without_exchange(catalog.QUERIES["bucketed_pairs"](spark, sf))


def test_a_hot_admission_is_as_small_as_others(spark, no_broadcast):
    """A third of all prescriptions in one admission; many buckets."""
    hot = spark.range(3_000).selectExpr("CAST(1 AS BIGINT) AS subject_id", "IF(id % 3 = 0, 7, id) AS hadm_id", "CONCAT('d', id % 10) AS drug", "TIMESTAMP'2150-01-01' AS starttime")
    stays = spark.range(3_000).selectExpr("CAST(1 AS BIGINT) AS subject_id", "id AS hadm_id", "id % 50 AS stay_id")
    frames = {"drugs": meds.admission_drugs(hot), "stays": meds.admission_stays(stays)}
    stored = bucketed.store_bucketed(frames, meds.ADMISSION, bucket_bytes=2_000)
    sizes = stored.frames["drugs"].groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert sizes[2] >= 8 and sizes[0] < sizes[1] / 4
    got = meds.drugs_of_stays(stored.frames["drugs"], stored.frames["stays"])
    assert joined_without_exchange(got)
    assert rows(got) == rows(meds.stay_drugs(hot, stays))
    stored.drop()
    assert not set(stored.tables.values()) & {t.name for t in spark.catalog.listTables()}


def test_bucket_counts_are_powers_of_two(spark, monkeypatch):
    for parts, wanted in ((1, 1), (3, 4), (8, 8), (1_000, 1_024)):
        monkeypatch.setattr(bucketed, "partitions_for", lambda df, target_bytes, n=parts: n)
        assert bucketed.bucket_count(None) == wanted


def test_counted_tables_give_the_same_pairs(spark, sf):
    dx, rx = stand_in.diagnoses(spark, sf), stand_in.prescriptions(spark, sf)
    stored = bucketed.store_bucketed({"codes": recommend.admission_codes(dx), "medications": recommend.admission_medications(rx)}, ["hadm_id"]).frames
    assert rows(recommend.pair_counts(stored["codes"], stored["medications"])) == rows(recommend.co_occurrence(dx, rx))


# --- tables side by side ---


def csv_files(folder, *names):
    for name in names:
        with gzip.open(f"{folder}/{name}.csv.gz", "wt") as out:
            out.write("a,b\n" + "".join(f"{i},{name}{i}\n" for i in range(50)))
    return {name: f"{folder}/{name}.csv.gz" for name in names}


def test_tables_are_converted_side_by_side(spark, fresh_dir, monkeypatch):
    """Each conversion waits until another one has begun."""
    met, convert, pools = threading.Barrier(2, timeout=60), csv_ingest.convert_csv, []

    def slow(spark, source, target, table, keep):
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        met.wait()
        return convert(spark, source, target, table, keep)

    monkeypatch.setattr(csv_ingest, "convert_csv", slow)
    status = csv_ingest.ingest_tables(spark, csv_files(fresh_dir, "one", "two"), fresh_dir)
    assert rows(status, "table", "rows_out", "ok") == [("one", 50, True), ("two", 50, True)]
    assert sorted(pools) == ["ingest-one", "ingest-two"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failing_table_leaves_the_others(spark, fresh_dir):
    sources = csv_files(fresh_dir, "a", "b", "c", "d")
    sources["b"] = f"{fresh_dir}/none.csv.gz"
    status = csv_ingest.ingest_tables(spark, sources, fresh_dir, at_once=3)
    assert [(r["table"], r["ok"]) for r in status.collect()] == [("a", True), ("b", False), ("c", True), ("d", True)]


def test_scopes_of_threads_keep_to_their_own_tables(spark):
    inside, leave = threading.Event(), threading.Event()
    paths = {}

    def holds():
        with session.scratch_scope(spark):
            paths["held"] = session.materialize(spark.range(5), "held").inputFiles()
            inside.set()
            leave.wait(60)
            paths["rows"] = spark.read.parquet(*paths["held"]).count()

    thread = threading.Thread(target=holds)
    thread.start()
    assert inside.wait(60)
    with session.scratch_scope(spark):
        session.materialize(spark.range(5), "other")
    leave.set()
    thread.join(60)
    assert paths["rows"] == 5
