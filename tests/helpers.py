"""Small fixture tables and plan text."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardline import schemas as S


def rows(df, *columns):
    """Rows as sorted tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def chart_row(stay, item, value, chart="2150-01-01 00:00:00", store=None, subject=1, hadm=10):
    return (subject, hadm, stay, item, value, value, "unit", chart, store)


def charts(spark, *entries):
    return spark.createDataFrame([chart_row(*e) if isinstance(e, tuple) else e for e in entries], S.CHARTEVENTS)


def global_sequence(df, order_by, name="seq"):
    """Zero-based row number over one window, for small frames."""
    window = Window.partitionBy(F.lit(1)).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window).cast("long") - 1)
