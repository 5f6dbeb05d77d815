from pyspark.sql import functions as F

from vitarium.operators import listing


def test_state_and_resume(spark):
    events = spark.createDataFrame(
        [("a", 1, 1, 3, "<1>", False), ("a", 2, 2, 3, "<2>", False), ("b", 3, 1, 1, "x", False), ("b", 4, 1, 1, None, True),
         ("c", 5, 4, 9, "", False), ("a", 6, None, None, None, None)],
        "index_url string, seq int, page long, total_pages long, html string, completed boolean",
    ).selectExpr("*", "timestamp_seconds(seq) AS updated_at")
    state = listing.fold_listing_state(events, seq="seq")
    got = {r.index_url: (r.page, r.total_pages, r.html, r.completed, r.last_page) for r in state.collect()}
    assert got == {"a": (2, 3, "<2>", False, None), "b": (1, 1, "x", True, 1), "c": (4, 9, "", False, 4)}
    state = listing.fold_listing_state(events.filter("seq < 6"), seq="seq")
    index = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "index_url string")
    got = {r.index_url: (r.start_page, r.resumed) for r in listing.resume_points(index, state).collect()}
    assert got == {"a": (2, True), "c": (1, False), "d": (1, False)}


def test_completed_only_at_the_last_page(spark):
    df = spark.createDataFrame([(1, 3), (3, 3), (4, None)], "page long, total_pages long")
    assert [r.completed for r in listing.listing_events(df).collect()] == [False, True, False]


def test_pages_ahead_and_gaps(spark):
    state = spark.createDataFrame([("a", 2, 3), ("b", 3, 3), ("c", None, 12), ("d", 1, None)],
                                  "index_url string, last_page long, total_pages long")
    got = sorted(map(tuple, listing.pages_ahead(state, max_pages=4).collect()))
    assert got == [("a", 3), ("c", 1), ("c", 2), ("c", 3), ("c", 4)]
    captured = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("b", 1), ("b", 2), ("b", 3)],
                                     "index_url string, page_no int")
    totals = state.select("index_url", "total_pages").filter("index_url < 'c'")
    assert sorted(map(tuple, listing.page_gaps(captured, totals).collect())) == [("a", 2)]


def test_crawl_totals(spark):
    read = spark.createDataFrame([("a", 10, True), ("a", 12, False), ("b", 1, None)],
                                 "index_url string, total_pages long, resumed boolean")
    assert tuple(listing.crawl_totals(read, resumed="resumed").first()) == (13, 2)
    assert tuple(listing.crawl_totals(read.filter("false")).first()) == (0, 0)


def test_one_long_index_is_spread(spark):
    state = spark.createDataFrame([("a", 4, 1_000_003)], "index_url string, last_page long, total_pages long")
    ahead = listing.pages_ahead(state)
    got = ahead.agg(F.count("*"), F.min("page_no"), F.max("page_no"), F.count_distinct("page_no")).first()
    assert tuple(got) == (999_999, 5, 1_000_003, 999_999)
    sizes = [r["count"] for r in ahead.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 400_000
