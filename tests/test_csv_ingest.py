import gzip
import os

import pytest
from helpers import rows

from wardline.sources import csv_ingest


def write_gz(folder, name, text):
    path = f"{folder}/{name}.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


def test_null_tokens_and_quoted_newlines(spark, fresh_dir):
    path = write_gz(fresh_dir, "t", 'a,b\nNULL,"two\nlines"\nN/A,"say ""hi"""\n,x\nNaN, \né,n/a\n')
    frame = csv_ingest.normalize_nulls(csv_ingest.read_csv_text(spark, path))
    assert [tuple(r) for r in frame.collect()] == [
        (None, "two\nlines"), (None, 'say "hi"'), (None, "x"), (None, None), ("é", None),
    ]


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1", "2", "3"], "bigint"),
        (["1", "2", None, "4"], "double"),
        (["1", "2.5", "3"], "double"),
        (["1", "2.0"], "double"),
        (["1"] * 7 + ["x"] * 3, "string"),
        (["1"] * 71 + ["x"] * 29, "double"),
        (["1"] * 7 + [None] * 3, "string"),
        (["1D", "2f", "NaN", "inf"], "string"),
        (["1e3", "-.5", "+2."], "double"),
        ([None, None], "string"),
        (["99999999999999999999", "1"], "double"),
    ],
)
def test_type_rule(spark, values, expected):
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    assert csv_ingest.infer_types(frame) == {"c": expected}


def test_cast_nulls_what_is_no_number(spark):
    frame = spark.createDataFrame([("1",), ("1D",), ("x",)], "c string")
    assert rows(csv_ingest.apply_types(frame, {"c": "double"})) == [(1.0,), (None,), (None,)]


def test_no_row_is_lost_over_many_chunks(spark, fresh_dir):
    lines = "".join(f'{i:06d},{i / 2},"note\n{i}"\n' for i in range(60_000))
    path = write_gz(fresh_dir, "big", "code,half,note\n" + lines)
    status = csv_ingest.convert_csv(spark, path, f"{fresh_dir}/out", "big", keep_string=("code",))
    assert (status["rows_in"], status["rows_out"], status["ok"]) == (60_000, 60_000, True)
    out = spark.read.parquet(f"{fresh_dir}/out")
    assert dict(out.dtypes) == {"code": "string", "half": "double", "note": "string"}
    assert out.filter("code = '000007'").first()["half"] == 3.5
    assert any(f.endswith(".snappy.parquet") for f in os.listdir(f"{fresh_dir}/out"))


def test_failing_tables_are_skipped_and_reported(spark, fresh_dir):
    path = write_gz(fresh_dir, "ok", "a\n1\n2\n")
    with open(f"{fresh_dir}/broken.csv.gz", "wb") as out:
        out.write(open(path, "rb").read()[:-12] + b"x" * 40)
    inputs = {"broken": f"{fresh_dir}/broken.csv.gz", "gone": f"{fresh_dir}/none.csv.gz", "ok": path}
    status = csv_ingest.ingest_tables(spark, inputs, fresh_dir)
    assert rows(status, "table", "rows_out", "ok") == [
        ("broken", None, False), ("gone", None, False), ("ok", 2, True),
    ]
    assert all(n.startswith("failed: ") for (n,) in rows(status.filter("not ok"), "note"))
    with pytest.raises(RuntimeError, match="gone"):
        csv_ingest.require_complete(status)
    csv_ingest.require_complete(status.filter("ok"))


def test_lost_rows_are_noticed(spark, fresh_dir):
    spark.range(3).write.parquet(f"{fresh_dir}/out")
    status = csv_ingest.verify_copy(spark, 5, f"{fresh_dir}/out", "t")
    assert not status["ok"] and status["note"] == "2 rows lost"


def test_lines_with_too_many_fields_are_rejected_whole(spark, fresh_dir):
    path = write_gz(fresh_dir, "ragged", 'a,b\n1,x\n2\n3,y,z\n4,v,\n5,"q,r"\n')
    status = csv_ingest.convert_csv(spark, path, f"{fresh_dir}/out")
    assert (status["rows_in"], status["rows_out"], status["ok"]) == (5, 3, False)
    assert status["note"] == (
        "1 lines with fewer fields than the header; 2 lines with more fields than the header rejected"
    )
    assert rows(spark.read.parquet(f"{fresh_dir}/out")) == [(1, "x"), (2, None), (5, "q,r")]
    assert rows(spark.read.parquet(f"{fresh_dir}/out_rejects")) == [("3,y,z",), ("4,v,",)]
    assert csv_ingest.convert_csv(spark, path, f"{fresh_dir}/out", allow_ragged=True)["ok"]


def test_columns_go_by_each_files_header(spark, fresh_dir):
    os.mkdir(f"{fresh_dir}/in")
    write_gz(f"{fresh_dir}/in", "one", "x,y\n1,aa\n")
    write_gz(f"{fresh_dir}/in", "two", "y,x\nbb,2\n")
    write_gz(f"{fresh_dir}/in", "three", "x\n3\n")
    status = csv_ingest.convert_csv(spark, f"{fresh_dir}/in", f"{fresh_dir}/out")
    assert status["ok"] and rows(spark.read.parquet(f"{fresh_dir}/out"), "x", "y") == [
        (1, "aa"), (2, "bb"), (3, None),
    ]
