"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries, standins
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    notes, rows, _ = differences(spark, connection, FOLDER, name)
    assert not notes
    assert rows > 0


def test_page_files_grow_with_the_documents(spark, scratch, monkeypatch):
    """No task writes a fixed share of all pages, and a stream still takes them in two micro-batches."""
    folder, out = scratch("tables"), scratch("pages")
    documents = spark.range(400).selectExpr(
        "id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'web' AS source", "10L AS n_chars")
    documents.write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: out)
    monkeypatch.setattr(queries, "FILE_BYTES", 1 << 10, raising=False)
    queries._page_files(spark, folder, standins.DETAIL_PAGES)
    pages = spark.read.parquet(out)
    spans = pages.groupBy(F.input_file_name()).agg(F.min("page_seq").alias("low"), F.max("page_seq").alias("high")).orderBy("low").collect()
    assert pages.count() == 400 and len(spans) > 8
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))
