from pyspark.sql import functions as F

from wardline.operators import meds
from wardline.sources import bucketed


def test_buckets_are_sized_by_their_rows_not_their_files(spark):
    """Long repeated drug names are small as Parquet but not in a task: a bucket holds about bucket_bytes of rows."""
    rx = spark.range(400).selectExpr(
        "id AS subject_id", "id AS hadm_id", "REPEAT('d', 10000) AS drug", "TIMESTAMP'2150-01-01' AS starttime"
    )
    drugs = meds.admission_drugs(rx)
    stays = spark.range(400).selectExpr("id AS subject_id", "id AS hadm_id", "id AS stay_id")
    stored = bucketed.store_bucketed({"drugs": drugs, "stays": meds.admission_stays(stays)}, meds.ADMISSION, bucket_bytes=200_000)
    files = stored.frames["drugs"].select(F.input_file_name()).distinct().count()
    assert files >= 16
    most = stored.frames["drugs"].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most * 10_000 <= 2 * 200_000
    stored.drop()
