import datetime
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from vitarium.functions import text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("given, wanted", [
    (None, ""), ("", ""), ("  a \t\n b  c ", "a b c"), ("﻿a b　", "a b"), ("a  b", "a b"),
    (" a", "a"), ("a  ", "a"), ("\x0b\x0ca\r\nb", "a b"),
])
def test_normalize_text(spark, given, wanted):
    assert one(spark, text.normalize_text(F.lit(given).cast("string"))) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("  Działaczka społeczna, Łódź! ", "dzialaczka spoleczna lodz"), (None, ""), ("żółw-3", "zolw-3"),
    ("ЖЖ a ж b", "a b"), ("étude İ", "etude i"), ("\x00a_b", "a b"), ("Ünï©ø", "uni"),
])
def test_match_key(spark, given, wanted):
    assert one(spark, text.match_key(F.lit(given).cast("string"))) == wanted


def test_match_key_agrees_with_decomposition_for_every_letter(spark):
    """Brute force over all of the first three blocks of 4096 code points."""
    letters = [chr(p) for p in range(1, 0x3000) if not 0xD800 <= p < 0xE000]

    def brute(letter):
        plain = unicodedata.normalize("NFD", letter.lower())
        plain = "".join(c for c in plain if not 0x300 <= ord(c) < 0x370).replace("ł", "l")
        return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789-" else " " for c in plain).split())

    df = spark.createDataFrame([(c,) for c in letters], "c string")
    got = {r.c: r.k for r in df.select("c", text.match_key("c").alias("k")).collect()}
    assert {c: (got[c], brute(c)) for c in letters if got[c] != brute(c)} == {}


@pytest.mark.parametrize("given, wanted", [
    ("pisarka | poetka; działaczka społeczna", ["pisarka", "poetka", "działaczka społeczna"]),
    ("", []), (None, []), (" ;, |", []), (" a\tb\n,c", ["a\tb", "c"]), ("x", ["x"]), ("a b ;", ["a b"]),
])
def test_split_activities(spark, given, wanted):
    assert one(spark, text.split_activities(F.lit(given).cast("string"))) == wanted


def test_labels(spark):
    labels = F.array(F.lit(" a  b"), F.lit(" "), F.lit("c"), F.lit("a b"), F.lit(None))
    assert one(spark, text.join_labels(labels)) == "a b | c | a b"
    assert one(spark, text.join_labels(labels, distinct=True)) == "a b | c"


@pytest.mark.parametrize("given, wanted", [
    ("3-MEDIUM", 3), ("  12", 12), ("-4x", -4), ("x3", None), ("", None), ("+7", 7), ("99999999999", 99999999999),
])
def test_leading_int(spark, given, wanted):
    assert one(spark, text.leading_int(F.lit(given))) == wanted


def test_quickstatements_values(spark):
    assert one(spark, text.qs_quote(F.lit('a"b'))) == '"a%22b"'
    assert one(spark, text.qs_date(F.lit(datetime.date(2026, 6, 23)))) == "+2026-06-23T00:00:00Z/11"


@pytest.mark.parametrize("base, href, wanted", [
    ("https://H.test:443/a/b?x#y", "c/../d e", "https://h.test/a/d%20e"),
    ("https://h.test/a", "/für,", "https://h.test/f%C3%BCr,"),
    ("https://h.test", "?q='a'", "https://h.test/?q=%27a%27"),
    ("https://h.test/a?b=1", "#z", "https://h.test/a?b=1#z"),
    ("https://h.test/a?b=1#c", "", "https://h.test/a?b=1"),
    ("https://h.test/a", "//Other.com:8080/%2e%2e/x", "https://other.com:8080/x"),
    ("https://h.test/a/b/", "..", "https://h.test/a/"),
    ("https://h.test/a/b", "https:x", "https://h.test/a/x"),
    ("https://h.test/", " \n/a\tb\\c ", "https://h.test/ab/c"),
    ("https://h.test/", "mailto:a@b", "mailto:a@b"),
    ("https://h.test/", "http://Bücher.test/", "http://xn--bcher-kva.test/"),
    ("no base", "/a", None), ("https://h.test/", "http://", None), ("https://h.test/", "http://h:99999/", None),
])
def test_resolve_url(base, href, wanted):
    assert urls.resolve_url(base, href) == wanted


PIECES = ["http:", "https:", "HTTPS:", "mailto:", "ftp:", "//", "/", "///", "\\", "h.test", "A.B", "user:p@ss@", "u@", ":80", ":443", ":0080",
          ":99999", ":x", "[::1]", "]", "..", ".", "%2e", "%2E%2e", "a", "b c", "ł", "日", "?", "q=1", "#", "frag", "'", '"', "<", ">", "`", "{",
          "|", "^", "%zz", "\t", "\n", " ", "x:y", "@", ";", "&"]
BASES = ["https://Site.test/a/b/c?x=1#f", "http://h:80", "https://u:p w@h.test:8443/x/../y/", "ftp://f/", "mailto:x", "", None,
         "https://h.test?q", "https:///x", "http://[::1]:8080/a", "https://h.test/a/./b/../c/d%2e"]


def test_absolute_url_in_spark_equals_the_step_by_step_one(spark):
    rng = random.Random(6)

    def made(n):
        return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, n)))

    rows = [(rng.choice(BASES) if rng.random() < 0.8 else made(6), made(7) if rng.random() < 0.97 else None) for _ in range(6000)]
    df = spark.createDataFrame(rows, "base string, href string").select("base", "href", urls.absolute_url("base", "href").alias("url"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        wanted = urls.resolve_url(r.base, r.href)
        assert r.url == (None if "xn--" in (wanted or "") else wanted), (r.base, r.href)
    hosts = spark.createDataFrame([("https://ż.test/", "/ą"), ("https://a.test/", "ü b")], "base string, href string")
    got = hosts.select(urls.absolute_url("base", "href"), urls.absolute_url("base", "href", unicode_hosts=True)).collect()
    assert [tuple(r) for r in got] == [(None, urls.resolve_url("https://ż.test/", "/ą")), ("https://a.test/%C3%BC%20b",) * 2]
    assert got[0][1].startswith("https://xn--")


def test_index_urls(spark):
    initials = spark.createDataFrame([("A",), ("Ł",)], "initial string")
    base = "https://site.test/Search/Type,Biography/Initial,A/"
    for start in (base, "https://site.test/elsewhere"):
        got = [r.index_url for r in urls.index_urls(initials, start).orderBy("initial").collect()]
        assert got == [base, "https://site.test/Search/Type,Biography/Initial,%C5%81/"]


def test_record_key(spark):
    df = spark.createDataFrame(
        [("HTTP://A ", "b", "c"), ("", "B", "c"), (None, None, " N  M "), (" ", "b", "c"), (None, None, None)],
        "url string, biography_url string, name string")
    assert [r.record_key for r in urls.with_record_key(df).collect()] == ["http://a", "b", "n m", "", ""]
