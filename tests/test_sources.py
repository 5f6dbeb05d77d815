import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vitarium.fixed import RECORD_COLUMNS, STATEMENT_COLUMNS
from vitarium.operators import records as r
from vitarium.plans.linking import link_occupations
from vitarium.schema import DETAIL_STAGE, LISTING_STAGE, LOG_ORDER, RECORD
from vitarium.sources import csv_files, log, statements
from vitarium.sources.pages import read_pages
from vitarium.sources.tables import read_table


def text_of(path):
    return "".join(open(f, newline="").read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_csv_quotes_only_where_needed(spark, scratch):
    path = scratch("csv")
    df = spark.createDataFrame([('Jan "X"', "1900,1980", None, " a | b ", "")], "name string, dates string, n string, a string, e string")
    csv_files.write_records(df.coalesce(1), path)
    assert text_of(path) == 'name,dates,n,a,e\n"Jan ""X""","1900,1980",, a | b ,\n'


def test_csv_header_without_rows(spark, scratch):
    path = scratch("csv")
    csv_files.write_records(csv_files.empty_records(spark).coalesce(1), path)
    assert text_of(path).strip().split(",") == RECORD_COLUMNS


def test_csv_roundtrip_with_odd_cells(spark, scratch):
    path = scratch("csv")
    rows = [("a", 'x,"y"\nz', "1"), ("b", "", ""), ("", "", ""), ("ż", " pad ", '"'), ("c", "\\", 'a\\"b')]
    df = spark.createDataFrame(rows, "url string, name string, dates string")
    csv_files.write_records(df, path)
    got = csv_files.read_records(spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(x for x in rows if any(x))
    typed = csv_files.read_records(spark, path, schema=df.schema)
    assert typed.count() == 4


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("url,name\nu1,n1\n")
    (tmp_path / "b.csv").write_text("name,url,extra\nn2,u2,x\n")
    got = csv_files.read_records(spark, str(tmp_path), mixed_headers=True).select("url", "name", "extra").collect()
    assert sorted(map(tuple, got)) == [("u1", "n1", ""), ("u2", "n2", "x")]
    # taken for files of one header, they fail and are not misread
    for multi_line in (True, False):
        with pytest.raises(Exception, match="CSV header"):
            csv_files.read_records(spark, str(tmp_path), multi_line=multi_line).collect()


def test_csv_is_read_once_and_quoted_line_breaks_are_never_broken_in_silence(spark, tmp_path):
    (tmp_path / "a.csv").write_text('url,name,dates\nu1,"two\nlines",1900\nu2,short\n')
    whole = csv_files.read_records(spark, str(tmp_path))
    assert sorted(map(tuple, whole.collect())) == [("u1", "two\nlines", "1900"), ("u2", "short", "")]
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    torn = csv_files.read_records(spark, str(tmp_path), multi_line=False)
    for frame in (torn, torn.select("dates"), torn.select("url")):
        with pytest.raises(PySparkException, match="tears this row apart"):
            frame.collect()
    (tmp_path / "a.csv").write_text('url,name,dates\nu1,"a ""q"", b",1900\nu2,short\n,,\n')
    fine = csv_files.read_records(spark, str(tmp_path), multi_line=False)
    assert sorted(map(tuple, fine.collect())) == [("u1", 'a "q", b', "1900"), ("u2", "short", "")]


def test_csv_short_rows_and_positions(spark, scratch, tmp_path):
    (tmp_path / "a.csv").write_text('url,name,biography_text\nhttps://x/a,Old,"old, text"\n\n,,\nhttps://x/a,New\n')
    df = csv_files.read_records(spark, str(tmp_path), position=True)
    assert [tuple(x)[:3] for x in df.orderBy("row_no").collect()] == [
        ("https://x/a", "Old", "old, text"), ("https://x/a", "New", "")]
    merged = r.merge_records(df, seq=["file_path", "file_block", "row_no"])
    # a cell that is there but empty counts as present
    assert [(g.name, g.biography_text) for g in merged.collect()] == [("New", "")]


def test_aligned_columns():
    assert csv_files.aligned_columns([["x", "name"], ["url", "y", "x"]]) == ["url", "name", "x", "y"]
    assert csv_files.aligned_columns([]) == RECORD_COLUMNS


def test_log_append_compact_and_rerun(spark, scratch):
    path = scratch("log")
    assert log.scan_log(spark, path).count() == 0 and log.load_existing(spark, path).count() == 0
    row = spark.createDataFrame([("https://S/x", "P", "pisarz", 0, 0), ("", "", "", 1, 0)],
                                "url string, name string, activity string, page_seq long, card_pos int")
    log.append_checkpoint(row.withColumn("extra", F.lit(1)), path, batch_id=0)
    details = row.withColumn("biography_text", F.lit("Full.")).drop("activity")
    for _ in range(2):  # run again after a failure: same rows, not twice
        log.append_checkpoint(details, path, batch_id=0, stage=DETAIL_STAGE)
    rows = log.scan_log(spark, path)
    assert rows.count() == 2 and "extra" not in rows.columns
    assert tuple(r.log_progress(rows).first()) == (1, 1, 2)
    assert [g.url for g in r.enriched_urls(rows).collect()] == ["https://S/x"]
    assert [(g.activity, g.biography_text) for g in r.compact_latest(rows, seq=LOG_ORDER).collect()] == [(None, "Full.")]
    assert [(g.activity, g.biography_text) for g in log.load_existing(spark, path).collect()] == [("pisarz", "Full.")]
    early = log.scan_log(spark, path, upto=(LISTING_STAGE, 0))
    assert [g.biography_text for g in early.collect()] == [None]
    assert "stage" in early._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]


def test_snapshot_never_overwrites(spark, scratch):
    path = scratch("snapshot")
    df = spark.createDataFrame([(1, "a")], "seq int, url string")
    log.save_snapshot(df, path, seq="seq")
    with pytest.raises(PySparkException):
        log.save_snapshot(df, path, seq="seq")
    assert spark.read.parquet(path).count() == 1


def test_statement_files(spark, scratch):
    df = spark.createDataFrame([(n, f"Q{n}", f"u{n}", "aktor; a") for n in range(30)],
                               "id int, wikidata_qid string, url string, activity string")
    out = link_occupations(df, record_id="id")
    table, lines = scratch("statements"), scratch("qs")
    statements.write_statements(out, table, record_id="id")
    assert csv_files.read_records(spark, table).columns == STATEMENT_COLUMNS
    statements.write_quickstatements(out, lines, record_id="id", retrieved=F.lit("2026-06-23").cast("date"))
    items = [line.split("\t")[0] for line in text_of(lines).splitlines()]
    assert sorted(items) == sorted(r.item_qid for r in out.collect())


def test_pages_of_one_url_go_to_all_tasks(spark, scratch):
    path = scratch("pages")
    spark.range(4000).select(F.lit("https://one.test/").alias("url"), F.col("id").alias("page_seq"),
                             F.sha2(F.col("id").cast("string"), 256).alias("salt")).withColumn(
        "html", F.concat(*[F.sha2(F.concat("salt", F.lit(k)), 512) for k in range(40)])).drop("salt").coalesce(1).write.parquet(path)
    spread = read_pages(spark, path)
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * 4000 / len(sizes)
    assert "Exchange" not in read_pages(spark, path, spread=False)._jdf.queryExecution().executedPlan().toString()


def test_only_small_inputs_are_spread(spark, scratch):
    few, many = scratch("few"), scratch("many")
    spark.range(100).repartition(1).write.parquet(few)
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 27)  # one partition per file
    try:
        spark.range(100).repartition(12).write.parquet(many)

        def shuffles(path, column):
            return "Exchange" in read_table(spark, path, spread_by=column)._jdf.queryExecution().executedPlan().toString()

        assert shuffles(few, "id") and not shuffles(few, None) and not shuffles(many, "id")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert RECORD.names == RECORD_COLUMNS
