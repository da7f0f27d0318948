"""Every query on tables where one key, or copies of one row, hold a third of all rows."""

import shutil
import tempfile

import compare
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wardline.plans import catalog

NAMES = sorted(catalog.ORACLES)


def with_hot_key(table, column, value, nth):
    """Every third row, counted from ``nth``, gets ``value``."""
    values = table[column].to_numpy().copy()
    values[nth::3] = value
    place = table.schema.get_field_index(column)
    return table.set_column(place, table.schema.field(column), pa.array(values, table.schema.field(column).type))


def with_copies(table, row):
    """One row repeated until its copies are a third of the table."""
    copies = table.take(np.full(len(table) // 2, row))
    return pa.concat_tables([table, copies])


@pytest.fixture(scope="module")
def skewed(sf):
    folder = tempfile.mkdtemp(prefix="wardline-skewed-")
    for name in compare.TABLES:
        shutil.copyfile(f"{sf}/{name}.parquet", f"{folder}/{name}.parquet")

    def rewrite(name, *steps):
        table = pq.read_table(f"{sf}/{name}.parquet")
        for step, *arguments in steps:
            table = step(table, *arguments)
        pq.write_table(table, f"{folder}/{name}.parquet", row_group_size=500)

    rewrite("events", (with_hot_key, "user_id", 3, 0), (with_copies, 11))
    rewrite("orders", (with_hot_key, "o_custkey", 3, 0), (with_copies, 5))
    rewrite("lineitem", (with_hot_key, "l_orderkey", 5, 0), (with_hot_key, "l_partkey", 9, 1), (with_copies, 1))
    return folder


@pytest.fixture(scope="module")
def connection(skewed):
    return compare.connect(skewed)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, connection, skewed, name):
    assert compare.difference(spark, connection, name, skewed) is None
