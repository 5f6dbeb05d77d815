import random

import pytest
from pyspark.sql import functions as F

from vitarium.operators import records as r
from vitarium.operators import skew

COLUMNS = "seq long, url string, name string, biography_text string, biography_error string"


def table(spark, rows):
    return spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], COLUMNS)


def random_log(seed, rows=300):
    rng = random.Random(seed)
    url = [None, "", " ", "http://A", "http://a", "HTTP://b", "c", "c", "c", "d"]
    return [(rng.choice(url), rng.choice([None, "", "n", "N", "m"]), rng.choice([None, "", "t1", "t2"]),
             rng.choice([None, None, "", "e"])) for _ in range(rows)]


def brute_key(url, name):
    return " ".join((url or name or "").split()).lower()


def test_merge_takes_latest_present_value_per_column(spark):
    df = table(spark, [("x", "Old", "old", None), ("X", "New", None, ""), ("x", None, "", None), (" ", "q", None, None)])
    got = r.merge_records(df, seq="seq").collect()
    assert [(g.record_key, g.url, g.name, g.biography_text, g.biography_error, g.first_seq) for g in got] == [
        ("x", "x", "New", "", "", 0)]


@pytest.mark.parametrize("seed", range(3))
def test_operators_against_brute_force(spark, seed):
    rows = random_log(seed)
    df = table(spark, rows).repartition(7)
    merged, latest, first, urls = {}, {}, {}, {}
    for n, row in enumerate(rows):
        key = brute_key(row[0], row[1])
        if row[0]:
            entry = urls.setdefault(row[0], [n, False])
            entry[1] |= bool(row[2] or row[3])
        if not key:
            continue
        first.setdefault(key, n)
        latest[key] = (n, *row)
        old = merged.get(key, (None,) * 4)
        merged[key] = tuple(o if v is None else v for o, v in zip(old, row))
    got = {g.record_key: tuple(g)[1:-1] for g in r.merge_records(df, seq="seq").collect()}
    assert got == merged
    got = {g.record_key: (tuple(g)[1:-1], g.first_seq) for g in r.compact_latest(df, seq="seq").collect()}
    assert got == {k: (latest[k], first[k]) for k in latest}
    known = table(spark, [("c", None, None, None)])
    got = {g.record_key: g.seq for g in r.new_records_only(df, known, seq="seq").collect()}
    assert got == {k: n for k, n in first.items() if k != "c"}
    assert {g.url: g.seq for g in r.detail_frontier(df, seq="seq").collect()} == {
        u: n for u, (n, done) in urls.items() if not done}
    stats = r.enrich_stats(df).first()
    done = sum(d for _, d in urls.values())
    assert tuple(stats) == (len(urls) - done, done, len(urls), len(first))
    assert tuple(r.log_progress(df).first()) == (len(first), done, len(rows))


def test_merge_is_idempotent_and_ignores_partitioning(spark):
    df = table(spark, random_log(9))
    once = r.merge_records(df, seq="seq")
    again = r.merge_records(once.drop("record_key"), seq="first_seq")
    assert sorted(map(tuple, once.drop("first_seq").collect()), key=str) == sorted(
        map(tuple, again.drop("first_seq").collect()), key=str)


def test_error_rows_are_final_unless_retried(spark):
    df = table(spark, [("a", "n", None, "HTTP 500"), ("b", "n", None, None), ("c", "n", "t", None)])
    assert [g.url for g in r.detail_frontier(df, seq="seq").collect()] == ["b"]
    assert sorted(g.url for g in r.detail_frontier(df, seq="seq", retry_errors=True).collect()) == ["a", "b"]


def test_enrich(spark):
    df = table(spark, [("a", "A", None, None), ("a", "A2", None, None), ("", "none", None, None), (None, "nil", None, None),
                       ("z", "Z", None, None)])
    details = spark.createDataFrame(
        [("a", "Full", "text", 1), ("a", "Stale", "old", 0), ("", "never", "never", 0)],
        "biography_url string, biography_name string, biography_text string, at int")
    got = r.enrich(df, details, seq="at").orderBy("seq").collect()
    assert [(g.name, g.biography_text, g.biography_name) for g in got] == [
        ("A", "text", "Full"), ("A2", "text", "Full"), ("none", None, None), ("nil", None, None), ("Z", None, None)]
    assert [g.seq for g in r.enrich(df, details, seq="at", how="inner").orderBy("seq").collect()] == [0, 1]


def test_capture_errors(spark):
    frontier = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    captured = spark.createDataFrame([("a", 500, 1), ("a", 200, 2), ("b", 404, 3)], "url string, status int, at int")
    assert [tuple(g) for g in r.capture_errors(frontier, captured, seq="at").collect()] == [("b", "HTTP 404 for b")]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_a_hot_key(spark, how):
    """A third of the rows share a key, others have none."""
    rows = [(n, "hot" if n % 3 == 0 else f"k{n % 17}" if n % 5 else "") for n in range(400)]
    left = spark.createDataFrame(rows, "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("", 5), (None, 6)], "k string, v int")
    wanted = sorted(map(str, left.join(right.filter("k <> ''"), "k", how).select("id", "k", "v").collect()))
    got = skew.lookup_join(left, right, "k", how=how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == wanted


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def splitting(spark):
    before = {k: spark.conf.get(k, None) for k in SPLITTING}
    for k, v in SPLITTING.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("keys", [1, 10_000])
def test_hot_rows_are_spread_without_being_counted(spark, splitting, keys):
    """One hot key, or ten thousand that hash unevenly: one scan of either side, and large partitions are split."""
    rows = 100_000
    text = F.sha2(F.col("id").cast("string"), 512).alias("text")
    left = spark.range(0, rows, 1, 8).select("id", F.concat(F.lit("hot"), F.col("id") % keys).alias("k"), text)
    left = left.unionByName(spark.range(0, rows, 1, 8).select("id", F.lit("hot0").alias("k"), text))
    right = spark.range(max(keys, 100)).select(F.concat(F.lit("hot"), "id").alias("k"), F.col("id").alias("v"))
    joined = skew.lookup_join(left, right, "k")
    sizes = [g[1] for g in joined.groupBy(F.spark_partition_id()).agg(F.count("text"), F.max("text")).collect()]
    assert sum(sizes) == 2 * rows and len(sizes) >= 16 and max(sizes) < rows / 4
    assert joined.filter("v <> substring(k, 4)").isEmpty()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_plans_shuffle_little_and_stay_in_the_engine(spark):
    """One shuffle per keyed operator, after a combine per task; no Python, no cross join."""
    df = table(spark, random_log(1)).repartition(3).selectExpr("*")
    known = table(spark, random_log(2))

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    for frame in (r.merge_records(df, seq="seq"), r.compact_latest(df, seq="seq"), r.detail_frontier(df, seq="seq")):
        text = plan(frame)
        assert text.count("Exchange hashpartitioning") == 1 and text.index("Exchange hash") < text.index("partial_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        anti = plan(r.new_records_only(df, known, seq="seq"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the batch once and the known keys once: the anti-join adds no shuffle of its own
    assert anti.count("Exchange hashpartitioning") == 2
    for text in (anti, plan(r.enrich(df, known.withColumnRenamed("url", "biography_url"))), plan(r.log_progress(df))):
        for name in ("Python", "MapIn", "Cartesian", "NestedLoop"):
            assert name not in text
