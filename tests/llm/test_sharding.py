import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import corpus
from vitarium.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000])
def test_permutation_is_a_bijection(spark, n):
    got = spark.range(n).select(sharding.permute(F.col("id"), n).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))


def test_rows_law(spark):
    rows = sharding.shard(corpus.frame(spark)).collect()
    assert len(rows) == len(corpus.rows())
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in corpus.rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_same_shards_however_rows_are_dealt(spark):
    keys = lambda parts: corpus.rows_of(sharding.shard(corpus.frame(spark, parts=parts)))
    assert keys(1) == keys(7)


def test_empty(spark):
    assert sharding.shard(corpus.empty(spark)).count() == 0
