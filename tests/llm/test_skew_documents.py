"""Text queries with SQL on tables where one source, or copies of one row, hold a third of all rows."""

import shutil

import compare
import pyarrow.parquet as pq
import pytest
from test_skew import with_copies, with_hot_key

from wardline.llm import catalog


@pytest.fixture(scope="module")
def skewed(sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed-documents"))
    for name in compare.TABLES:
        shutil.copyfile(f"{sf}/{name}.parquet", f"{folder}/{name}.parquet")
    documents = pq.read_table(f"{sf}/documents.parquet")
    documents = with_copies(with_hot_key(with_hot_key(documents, "source", "hot", 0), "lang", "en", 1), 3)
    pq.write_table(documents, f"{folder}/documents.parquet", row_group_size=50)
    pages = with_copies(with_hot_key(pq.read_table(f"{sf}/pages.parquet"), "url", "http://example.net/en/1", 0), 2)
    pq.write_table(pages, f"{folder}/pages.parquet", row_group_size=20)
    return folder


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, skewed, name):
    assert compare.difference(spark, compare.connect(skewed), name, skewed) is None
