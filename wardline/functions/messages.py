"""Events to JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.parsing import blank_to_null
from wardline.schemas import MESSAGE

BROKEN = "_broken"


def encode(df: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """One JSON text per event, with a null key; null fields are left out.

    Fields the input does not have are left out as well. Times carry
    milliseconds and the zone unless ``timestamp_format`` says otherwise.
    """
    sources = {"itemid": "itemid_str", "charttime": "charttime_ts", "storetime": "storetime_ts"}
    fields = []
    for name in MESSAGE.fieldNames():
        source = sources.get(name, name)
        if source in df.columns:
            fields.append(F.col(source).alias(name))
    options = {"timestampFormat": timestamp_format} if timestamp_format else {}
    return df.select(
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*fields), options).alias("value"),
    )


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Serving-table columns plus ``reject_reason``, null for a sound message."""
    wire = T.StructType([*MESSAGE.fields, T.StructField(BROKEN, T.StringType())])
    parsed = df.withColumn(
        "_m",
        F.from_json(
            F.col(value).cast("string"),
            wire,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN},
        ),
    )
    number = blank_to_null("_m.valuenum").try_cast("double")
    item = F.col("_m.itemid").try_cast("bigint")
    times = {n: F.col(f"_m.{n}").try_cast("timestamp") for n in ("charttime", "storetime", "event_time")}
    unread = [F.col(f"_m.{n}").isNotNull() & t.isNull() for n, t in times.items()]
    reason = (
        F.when(F.col("_m").isNull() | F.col(f"_m.{BROKEN}").isNotNull(), "malformed")
        .when(F.col("_m.itemid").isNotNull() & item.isNull(), "bad_itemid")
        .when(blank_to_null("_m.valuenum").isNotNull() & number.isNull(), "bad_valuenum")
        .when(unread[0] | unread[1] | unread[2], "bad_time")
    )
    fields: dict[str, Column] = {
        "timestamp": times["event_time"],
        **{n: F.col(f"_m.{n}") for n in ("subject_id", "hadm_id")},
        "itemid": item.cast("string"),
        **{n: F.col(f"_m.{n}") for n in ("vital_name", "value")},
        "valuenum": number,
        "valueuom": F.col("_m.valueuom"),
        **times,
    }
    kept = [F.col(c) for c in df.columns if c not in fields and c != value]
    return parsed.select(
        *kept,
        F.col(value).cast("string").alias("message"),
        reason.alias("reject_reason"),
        *[c.alias(n) for n, c in fields.items()],
    )
