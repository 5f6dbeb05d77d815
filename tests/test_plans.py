import datetime

import pytest
from pyspark.sql import functions as F

from checks.oracles import ORACLES
from tests.site import BASE, card, detail, listing, pages
from vitarium.operators.listing import pages_ahead, resume_points
from vitarium.operators.pages import listing_cards, pager_summary
from vitarium.operators.records import compact_latest, log_progress
from vitarium.plans import catalogue as c
from vitarium.schema import DETAIL_STAGE, LISTING_STAGE, LOG, LOG_ORDER, PAGES
from vitarium.sources import files, log
from vitarium.sources.log import scan_log
from vitarium.sources.pages import stream_pages
from vitarium.streaming import jobs

UNA = detail("Una", "Brook", "spring 1655", "1701", ["weaver", "dyer"], "Una wove.")
EZRA = detail("Ezra", "Field", "1660", "", ["piper"], "Ezra piped.")
HOST = "https://site.test"


def two_pages(spark):
    lists = pages(spark, [
        (BASE, listing([("1", None), ("2", "p2")], [card("/p/una", "Una", activities=["weaver"])])),
        (BASE, listing([("2", None)], [card("/p/ezra", "Ezra"), card("/p/una", "Una once more")]))])
    details = pages(spark, [(f"{HOST}/p/una", UNA), (f"{HOST}/p/ezra", EZRA)])
    return lists, details


def test_build_catalogue(spark):
    lists, details = two_pages(spark)
    got = c.build_catalogue(lists, details).orderBy("first_seq").collect()
    assert [(g.name, g.biography_name, g.biography_activities, g.biography_text) for g in got] == [
        ("Una once more", "Una Brook", "weaver | dyer", "Una wove."), ("Ezra", "Ezra Field", "piper", "Ezra piped.")]
    assert c.build_catalogue(lists, None).count() == 2
    totals = c.listing_totals(lists).first()
    assert tuple(totals) == (2, 2)


def existing(spark, *rows):
    df = spark.createDataFrame([(u, n, t, i) for i, (u, n, t) in enumerate(rows)],
                               "url string, name string, biography_text string, page_seq long")
    columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG]
    return df.select(*columns).fillna({"stage": 0, "batch_id": 0, "card_pos": 0})


def test_existing_details_are_kept_and_missing_ones_filled(spark):
    lists, details = two_pages(spark)
    old = existing(spark, (f"{HOST}/p/una", "Una of old", "Known before."),
                   (f"{HOST}/p/ezra", "Ezra of old", None))
    got = {g.url[-4:]: g for g in c.build_catalogue(lists, details, existing=old).collect()}
    assert len(got) == 2
    assert (got["/una"].name, got["/una"].biography_text, got["/una"].biography_name) == ("Una of old", "Known before.", None)
    assert (got["ezra"].name, got["ezra"].biography_text) == ("Ezra", "Ezra piped.")


def test_log_run(spark, scratch):
    lists, details = two_pages(spark)
    path = scratch("log")
    stats = c.extend_log(spark, lists, details, path, batch_id=0).first()
    assert tuple(stats) == (2, 0, 2, 2)
    rows = scan_log(spark, path)
    assert tuple(log_progress(rows).first()) == (2, 2, 4)
    # listing rows stand before any details, and the first listing of a person counts
    assert sorted(g.name for g in rows.filter(F.col("stage") == LISTING_STAGE).collect()) == ["Ezra", "Una"]
    snapshot = scratch("snapshot")
    c.compact_job(spark, path, snapshot)
    got = spark.read.parquet(snapshot).orderBy("first_seq").collect()
    assert [(g.name, g.biography_text) for g in got] == [("Una", "Una wove."), ("Ezra", "Ezra piped.")]
    # a second run finds nothing new
    assert tuple(c.extend_log(spark, lists, details, path, batch_id=1).first()) == (0, 2, 2, 2)
    assert scan_log(spark, path).count() == 4


def test_a_run_repeated_or_replayed_in_any_order_leaves_the_same_log(spark, scratch):
    lists, details = two_pages(spark)
    urls = [r.url for r in listing_cards(lists).select("url").distinct().collect()]
    first, second = details.filter(F.col("url") == urls[0]), details

    def rows(path):
        return sorted(tuple(r) for r in scan_log(spark, path).select(
            "stage", "batch_id", "record_key", F.coalesce("biography_text", F.lit(""))).collect())

    path = scratch("log")
    c.extend_log(spark, lists, first, path, batch_id=0)
    once = rows(path)
    assert tuple(c.extend_log(spark, lists, first, path, batch_id=0).first()) == (1, 0, 2, 2)
    assert rows(path) == once
    c.extend_log(spark, lists, second, path, batch_id=1)
    both = rows(path)
    assert len(both) == 4
    steps = [lambda: c.append_listing(spark, lists, path, batch_id=0), lambda: c.append_details(spark, first, path, batch_id=0),
             lambda: c.append_details(spark, second, path, batch_id=1)]
    for step in (*steps, *steps[::-1]):
        step()
        assert rows(path) == both
    assert tuple(c.extend_log(spark, lists, None, path, batch_id=2).first()) == (0, 2, 2, 2)


def log_rows(spark, path):
    return sorted((tuple(r) for r in scan_log(spark, path).select(
        "stage", "batch_id", "record_key", F.coalesce("biography_text", F.lit(""))).collect()))


@pytest.mark.parametrize("again", [[0], [1], [0, 1], [1, 0], [0, 1, 0], [1, 1, 0]])
def test_two_batches_run_again_in_any_order(spark, scratch, again):
    """Each batch lists one person, both have both detail pages."""
    lists, details = two_pages(spark)
    path = scratch("log")
    batches = [lists.filter("page_seq = 0"), lists.filter("page_seq = 1")]
    for n in (0, 1):
        c.extend_log(spark, batches[n], details, path, batch_id=n)
    once = log_rows(spark, path)
    assert [r[:2] for r in once] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    for n in again:
        c.extend_log(spark, batches[n], details, path, batch_id=n)
        assert log_rows(spark, path) == once


def test_a_run_starts_from_the_snapshot(spark, scratch):
    lists, details = two_pages(spark)
    path = scratch("log")
    c.extend_log(spark, lists.filter("page_seq = 0"), details, path, batch_id=0)
    c.append_listing(spark, lists, path, batch_id=1)
    before = sorted(map(str, log.latest_rows(spark, path).collect()))
    c.compact_job(spark, path)
    assert sorted(map(str, log.latest_rows(spark, path).collect())) == before
    assert tuple(log_progress(scan_log(spark, path)).first()) == (2, 1, 2)
    # an earlier bound is answered from the batches while they are there
    assert scan_log(spark, path, upto=(LISTING_STAGE, 0)).count() == 1
    c.compact_job(spark, path, drop=True)
    assert log.finished_batches(spark, path) == []
    with pytest.raises(ValueError, match="dropped"):
        scan_log(spark, path, upto=(LISTING_STAGE, 0))
    # covered batches are in the log for good; a new one finds who still lacks details
    assert not c.append_listing(spark, lists, path, batch_id=0) and not c.append_details(spark, details, path, batch_id=0)
    assert tuple(c.extend_log(spark, lists, details, path, batch_id=2).first()) == (1, 1, 2, 2)
    got = log.latest_rows(spark, path).orderBy("first_seq").collect()
    assert [(g.name, g.biography_text, g.first_seq.batch_id) for g in got] == [("Una", "Una wove.", 0), ("Ezra", "Ezra piped.", 1)]
    c.compact_job(spark, path, drop=True)
    assert sorted(map(str, log.latest_rows(spark, path).collect())) == sorted(map(str, got))
    assert not log.commit_snapshot(spark, path)


def test_a_killed_compaction_leaves_the_log_as_it_was(spark, scratch):
    lists, details = two_pages(spark)
    path = scratch("log")
    c.extend_log(spark, lists, details, path, batch_id=0)
    before = log_rows(spark, path)
    # rows without a manifest, a manifest that was begun, a batch that was begun
    log.latest_rows(spark, path).write.partitionBy("batch_id").parquet(f"{path}/_snapshots/half")
    spark.range(1).write.json(f"{path}/_commits/00000000/_temporary/0")
    scan_log(spark, path).drop("stage", "batch_id").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/stage=0/batch_id=7")
    assert log.snapshot_of(spark, path) is None and (0, 7) not in log.finished_batches(spark, path)
    files.remove(spark, f"{path}/stage=0/batch_id=7")
    assert log_rows(spark, path) == before
    c.compact_job(spark, path, drop=True)
    assert files.folders(spark, f"{path}/_snapshots") == [log.snapshot_of(spark, path).folder]
    assert scan_log(spark, path).count() == 2


def test_errors_in_a_snapshot_can_be_retried(spark, scratch):
    path = scratch("log")
    lists, _ = two_pages(spark)
    c.extend_log(spark, lists, pages(spark, [(f"{HOST}/p/una", "oops", 503)]), path, batch_id=0)
    c.compact_job(spark, path, drop=True)
    good = pages(spark, [(f"{HOST}/p/una", UNA)])
    c.append_details(spark, good, path, batch_id=1)
    assert scan_log(spark, path).filter("biography_text <> ''").count() == 0
    c.append_details(spark, good, path, batch_id=2, retry_errors=True)
    una = log.latest_rows(spark, path).filter("name = 'Una'").first()
    assert (una.biography_text, una.biography_error) == ("Una wove.", None)


def test_a_micro_batch_reads_only_buckets_its_keys_fall_into(spark, scratch, monkeypatch):
    """Bytes of the log that a batch reads stay the same however many batches came before."""
    monkeypatch.setattr(log, "BUCKET_ROWS", 20)
    path, read, seen = scratch("log"), [], []
    plain = log.scan_snapshot

    def counted(session, where, state, *, keys=None):
        rows = plain(session, where, state, keys=keys)
        names = rows.inputFiles()  # files of the buckets asked for
        touched = rows.select(F.input_file_name()).distinct().count()
        seen.append((touched, state.buckets, len(names)))
        return rows
    for n in range(12):
        lists = pages(spark, [(f"{BASE}{n}", listing([], [card(f"/p/{n}-{k}", f"P{n}-{k}") for k in range(40)] + [card("/p/0-0", "again")]))])
        with monkeypatch.context() as patch:
            patch.setattr(c, "scan_snapshot", counted)
            few = lists if n < 4 else pages(spark, [(f"{BASE}{n}", listing([], [card(f"/p/{n}-0", "one"), card("/p/0-0", "again")]))])
            c.append_listing(spark, few, path, batch_id=2 * n)
        read.append(seen[-1] if seen else None)
        c.append_listing(spark, lists, path, batch_id=2 * n + 1)
        log.commit_snapshot(spark, path, bucket_rows=20)
        log.drop_covered(spark, path)
    assert scan_log(spark, path).count() == 12 * 40
    assert read[-1][1] > 2 * read[4][1]  # many more buckets by now
    assert all(touched <= 2 for touched, *_ in read[4:])


def test_each_page_is_parsed_once(spark, scratch):
    lists, details = two_pages(spark)
    plan = c.build_catalogue(lists, details)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Scan") == 2
    parsed = c.read_once(spark, lists, scratch("parsed"))
    for frame in (listing_cards(parsed, keep=["page_seq"]), c.listing_progress(parsed), c.listing_errors(parsed), c.index_links(parsed)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in text and "part" in text.split("PartitionFilters")[1][:60]
    path = scratch("log")
    c.extend_log(spark, parsed, details, path, batch_id=0)
    assert log_rows(spark, path)[0][3] == "" and len(log_rows(spark, path)) == 4


def test_unreadable_listing_pages_are_told(spark):
    df = pages(spark, [(BASE, None), (BASE, listing([], [card("/p/1", "One")])), (BASE, "gone", 404)])
    errors = {r.page_seq: r.error for r in c.listing_errors(df).collect()}
    assert errors == {0: "no html captured", 2: f"HTTP 404 for {BASE}"}
    assert listing_cards(df.filter("page_seq = 1")).count() == 1


def test_failed_pages_become_error_rows(spark, scratch):
    path = scratch("log")
    lists, _ = two_pages(spark)
    captured = pages(spark, [(f"{HOST}/p/una", "oops", 503), (f"{HOST}/p/ezra", None)])
    c.extend_log(spark, lists, captured, path, batch_id=0)
    got = {g.name: g.biography_error for g in scan_log(spark, path).filter(F.col("stage") == DETAIL_STAGE).collect()}
    assert got == {"Una": f"HTTP 503 for {HOST}/p/una", "Ezra": "no html captured"}
    # errors are final, unless retried with a later capture
    good = pages(spark, [(f"{HOST}/p/una", UNA)])
    c.append_details(spark, good, path, batch_id=1)
    assert scan_log(spark, path).filter("biography_text <> ''").count() == 0
    c.append_details(spark, good, path, batch_id=2, retry_errors=True)
    latest = {g.name: (g.biography_text, g.biography_error)
              for g in compact_latest(scan_log(spark, path), seq=LOG_ORDER).collect()}
    assert latest["Una"][0] == "Una wove."


def test_twelve_pages_in_two_pager_windows(spark):
    def window(page):
        first, last = (1, 10) if page <= 10 else (11, 12)
        labels = [(str(n), None if n == page else f"pager_{n}") for n in range(first, last + 1)]
        return labels + ([(">", "pager_next")] if last < 12 else [])

    lists = pages(spark, [(BASE, listing(window(n), [card(f"/p/{n}", f"Reader {n}")])) for n in range(1, 13)])
    got = c.build_catalogue(lists, None).orderBy("first_seq").collect()
    assert len(got) == 12 and got[-1].name == "Reader 12"
    assert tuple(c.listing_totals(lists).first()) == (12, 12)
    assert pager_summary(lists, keep=["page_seq"]).filter("page_seq + 1 = current_page").count() == 12


def test_listing_resumes_after_the_saved_page(spark, scratch):
    """Pages 1 and 2 of 3 were read; page 3 is what is left, and it completes the listing."""
    pager = [[("1", None), ("2", "p2")], [("1", "p1"), ("2", None), ("3", "p3")], [("2", "p2"), ("3", None)]]
    lists = pages(spark, [(BASE, listing(pager[n], [card(f"/p/{n + 1}", f"Reader {n + 1}")])) for n in range(3)])
    path = scratch("log")
    before, after = lists.filter("page_seq < 2"), lists.filter("page_seq = 2")
    c.append_listing(spark, before, path, batch_id=0)
    progress = c.listing_progress(before)
    index = c.index_url_table(spark, BASE, ["A", "B"])
    points = resume_points(index.select("index_url"), c.listing_state(progress)).collect()
    assert sorted((p.index_url[-2:], p.start_page, p.resumed) for p in points) == [("A/", 2, True), ("B/", 1, False)]
    assert [r.page_no for r in pages_ahead(c.listing_state(progress)).collect()] == [3]
    assert [r.page_no for r in c.missing_listing_pages(progress).collect()] == [3]
    assert c.missing_listing_pages(progress, max_pages=2).count() == 0
    c.append_listing(spark, after, path, batch_id=1)
    assert sorted(r.name for r in scan_log(spark, path).collect()) == ["Reader 1", "Reader 2", "Reader 3"]
    everything = c.listing_progress(lists)
    assert c.missing_listing_pages(everything).count() == 0
    points = resume_points(index.select("index_url"), c.listing_state(everything)).collect()
    assert [p.index_url[-2:] for p in points] == ["B/"]


def test_a_listing_ends_where_no_link_leads_on(spark):
    """Pagers name page 9; pages are walked from 1 until one links no further."""
    def walked(*numbered):
        lists = pages(spark, [(BASE, listing([(str(no), None), ("9", "far"), *links], [])) for no, links in numbered])
        progress = c.listing_progress(lists)
        state = c.listing_state(progress).first()
        return state.last_page, state.completed, sorted(r.page_no for r in c.missing_listing_pages(progress).collect())

    def on(no):
        return no, [(str(no + 1), f"p{no + 1}")]
    assert walked(on(1), on(2), (3, [])) == (3, True, [])
    assert walked(on(1), on(2), (3, [(">", "next")])) == (3, False, [4, 5, 6, 7, 8, 9])
    assert walked(on(1), (3, [])) == (3, False, [2, 4, 5, 6, 7, 8, 9])  # page 2 is missing
    assert walked(on(2), (3, [])) == (3, False, [1, 4, 5, 6, 7, 8, 9])
    assert walked((1, [])) == (1, True, [])
    # of a page captured twice the later capture counts
    assert walked(on(1), on(2), (2, [])) == (2, True, [])
    assert walked(on(1), (2, []), on(2)) == (2, False, [3, 4, 5, 6, 7, 8, 9])


def test_index_pages(spark):
    assert c.index_url_table(spark, BASE, ["A", "Ł"]).count() == 2
    assert c.index_url_table(spark, BASE).select("index_url").distinct().count() == 30
    assert [r.index_url for r in c.index_url_table(spark, BASE, []).collect()] == [BASE]
    start = pages(spark, [(BASE, '<div class="letters"><a href="/Search/Type,Biography/Initial,B/">B</a></div>')])
    assert [r.index_url[-2:] for r in c.discovered_index_urls(start).collect()] == ["B/"]
    assert [r.index_url for r in c.discovered_index_urls(pages(spark, [(BASE, "<p>")])).collect()] == [BASE]


def many(spark, count=60):
    lists = [(f"{BASE}{n}", listing([("1", None)], [card(f"/p/{n % 20}", f"N{n}"), card(f"/p/{n % 7}", f"M{n}")]))
             for n in range(count)]
    details = [(f"{HOST}/p/{n}", detail("G", str(n), "", "", [], f"text {n}")) for n in range(15)]
    return pages(spark, lists), pages(spark, details)


@pytest.mark.parametrize("batches", [1, 4])
def test_batches_then_compaction_equal_one_run(spark, scratch, batches):
    lists, details = many(spark)
    path = scratch("log")
    for n in range(batches):
        part = lists.filter((F.col("page_seq") >= 60 * n // batches) & (F.col("page_seq") < 60 * (n + 1) // batches))
        c.append_listing(spark, part, path, batch_id=n)
    c.append_details(spark, details, path, batch_id=0)
    got = compact_latest(scan_log(spark, path), seq=LOG_ORDER).collect()
    assert sorted((g.url, g.name, g.biography_text) for g in got) == sorted(
        (f"{HOST}/p/{n}", first_name(n), f"text {n}" if n < 15 else None) for n in range(20))


def first_name(n):
    """Name on the first card that links to person ``n``."""
    for page in range(60):
        if page % 20 == n:
            return f"N{page}"
        if page % 7 == n:
            return f"M{page}"


def test_streams_equal_batches(spark, scratch):
    lists, details = many(spark)
    folder, path, checkpoint = scratch("pages"), scratch("log"), scratch("checkpoint")
    typed = lists.select(*[F.col(f.name).cast(f.dataType) for f in PAGES])

    def ingest():
        jobs.ingest_stream(stream_pages(spark, folder, files_per_batch=2), path, checkpoint).awaitTermination()

    typed.filter("page_seq < 30").repartitionByRange(5, "page_seq").write.parquet(folder)
    ingest()
    first = scan_log(spark, path).count()
    assert first == 20
    typed.filter("page_seq >= 30").repartition(3).write.mode("append").parquet(folder)
    ingest()
    assert scan_log(spark, path).count() == 20
    more = scratch("details")
    details.select(*[F.col(f.name).cast(f.dataType) for f in PAGES]).repartition(3).write.parquet(more)
    jobs.enrich_stream(stream_pages(spark, more, files_per_batch=1), path, scratch("checkpoint")).awaitTermination()
    got = compact_latest(scan_log(spark, path), seq=LOG_ORDER)
    assert got.count() == 20 and got.filter("biography_text is not null").count() == 15
    assert got.select("url").distinct().count() == 20


def test_streams_compact_the_log_as_they_go(spark, scratch):
    lists, details = many(spark)
    folder, path, checkpoint = scratch("pages"), scratch("log"), scratch("checkpoint")
    lists.select(*[F.col(f.name).cast(f.dataType) for f in PAGES]).repartitionByRange(6, "page_seq").write.parquet(folder)
    jobs.ingest_stream(stream_pages(spark, folder, files_per_batch=1), path, checkpoint, compact_every=2).awaitTermination()
    assert log.snapshot_of(spark, path).covers(LISTING_STAGE, 5) and scan_log(spark, path).count() == 20
    log.drop_covered(spark, path)
    assert scan_log(spark, path).count() == 20
    with pytest.raises(ValueError, match="run_id"):  # used, though its folders are gone
        jobs.ingest_stream(stream_pages(spark, folder), path, scratch("other"))


def test_stream_dedupe_forgets_keys_behind_the_watermark(spark, scratch):
    """Two thousand keys over time, a few at once: state holds those of the span, first rows come whole."""
    folder = scratch("records")
    schema = "url string, name string, n long, at timestamp"
    for part in range(8):
        rows = [(f"k{part * 50 + n % 50}", f"row {n}", part * 1000 + n, datetime.datetime(2026, 1, 1 + part)) for n in range(200)]
        rows += [(f"k{part * 50}", "late again", part * 1000 - 900, datetime.datetime(2026, 1, 1 + part))] if part else []
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    records = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    known = spark.createDataFrame([("K3", "known")], "url string, name string")
    first = jobs.stream_dedupe(records, seq="n", event_time="at", forget_after="2 days", known=known)
    out = scratch("first")
    query = (first.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch("checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    span = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    got = {r.url: (r.name, r.n) for r in spark.read.parquet(out).collect()}
    assert len(got) == 8 * 50 - 1 and "k3" not in got
    assert got["k7"] == ("row 7", 7) and got["k50"] == ("late again", 100) and got["k51"] == ("row 1", 1001)
    assert max(span) <= 5 * 50


def test_state_versions_hold_only_what_changed(spark, scratch):
    folder, out = scratch("events"), scratch("state")
    schema = "index_url string, seq long, page long, html string, updated_at timestamp"
    at = datetime.datetime(2026, 1, 1)
    for rows in ([(f"i{n}", 1, 1, "<p>", at) for n in range(10)], [("i3", 2, 5, "<p>", at)], [("i3", 3, None, "", at), ("i4", 2, 2, "", at)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    state = jobs.stream_state(events, seq="seq")
    jobs.write_state(state, out, scratch("checkpoint")).awaitTermination()
    assert [spark.read.parquet(f"{out}/version={v}").count() for v in range(3)] == [10, 1, 2]
    got = {r.index_url: (r.page, r.last_page) for r in jobs.read_state(spark, out, state.schema).collect()}
    assert got == {f"i{n}": (1, 1) for n in range(10)} | {"i3": (5, None), "i4": (2, 2)}
    assert "html" not in state.columns


def test_state_can_keep_the_latest_html(spark, scratch):
    folder, out = scratch("events"), scratch("state")
    schema = "index_url string, seq long, page long, html string, updated_at timestamp"
    at = datetime.datetime(2026, 1, 1)
    for rows in ([("a", 1, 1, "<p>1", at), ("b", 1, 1, "<p>1", at), ("c", 1, 1, None, at)], [("a", 2, 2, "<p>2", at), ("b", 2, 2, None, at)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    state = jobs.stream_state(events, seq="seq", keep_html=True)
    jobs.write_state(state, out, scratch("checkpoint")).awaitTermination()
    got = {r.index_url: (r.last_page, r.html) for r in jobs.read_state(spark, out, state.schema).collect()}
    assert got == {"a": (2, "<p>2"), "b": (2, "<p>1"), "c": (1, None)}


def test_stream_state_query_and_sql_have_the_html():
    assert "EXCLUDE" not in ORACLES["stream_state"]


def test_a_new_checkpoint_needs_a_new_run(spark, scratch):
    lists, _ = many(spark)
    folder, path = scratch("pages"), scratch("log")
    lists.select(*[F.col(f.name).cast(f.dataType) for f in PAGES]).write.parquet(folder)
    jobs.ingest_stream(stream_pages(spark, folder), path, scratch("first")).awaitTermination()
    with pytest.raises(ValueError, match="run_id"):
        jobs.ingest_stream(stream_pages(spark, folder), path, scratch("second"))
    jobs.ingest_stream(stream_pages(spark, folder), path, scratch("third"), run_id=1).awaitTermination()
    assert scan_log(spark, path).count() == 20


def test_a_repeated_batch_replaces_itself(spark, scratch):
    lists, details = many(spark)
    path = scratch("log")
    for _ in range(2):
        c.append_listing(spark, lists, path, batch_id=3)
    for _ in range(2):
        c.append_details(spark, details, path, batch_id=3)
    assert scan_log(spark, path).count() == 35


def test_python_runs_only_where_pages_are_parsed(spark):
    lists, details = two_pages(spark)
    plan = c.build_catalogue(lists, details)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan and "NestedLoop" not in plan
    assert listing_cards(lists).columns == ["page_url", "card_pos", "url", "name", "dates", "activity"]
