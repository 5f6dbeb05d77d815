import os
import pathlib
import subprocess
import sys
import time

from pyspark.sql import functions as F

from tests.site import BASE, card, detail, listing, pages
from vitarium.operators import pages as p
from vitarium.operators.extract import Part, Rule, Search, extract, extract_parts, find_parts, find_values

PAGER = listing([("4", None), ("5", "go_to_five"), ("6", "go_six"), (">", "go_on_")], [])


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_pager(spark):
    df = pages(spark, [("u", PAGER), ("none", "<p>x"), ("odd", '<div class="pages"><span>x</span><a>5th</a></div>')])
    assert rows(p.pager_summary(df), "url") == [("none", 1, 1), ("odd", 5, 1), ("u", 6, 4)]
    assert rows(p.pager_links(df).select("page_no", "is_next", "dom_id", "target"), "page_no") == [
        (None, True, "go_on_", "go$on$"), (5, False, "go_to_five", "go$to$five"), (6, False, "go_six", "go$six")]


def test_last_pager_link_of_a_label_counts(spark):
    df = pages(spark, [("u", '<div class="pages"><a id="x">2</a><a>2</a><a id="y">2</a></div>')])
    assert [r.dom_id for r in p.pager_links(df).collect()] == ["y"]


def test_cards(spark):
    html = card("/p/wren", "Olga <i>Wren</i>", "c. 1712", activities=["glass", " ", "ink &amp; dye"])
    html += '<div class="personItem"><div class="name">x</div></div><div class="personItem"><p>'
    got = rows(p.listing_cards(pages(spark, [(BASE, html), ("n", None), ("e", "")])).drop("page_url"), "card_pos")
    assert got == [
        (0, "https://site.test/p/wren", "Olga Wren", "c. 1712", "glass | ink & dye"),
        (1, "", "", "", ""), (2, "", "", "", "")]


def test_details(spark):
    full = '<meta property="og:title" content="Other" />' + detail(
        "Piet", "Hollander", "in May 1702", "?", ["miller", "sáilor", "miller"], "He <p>ran<p>the mill.")
    only_title = '<meta property="og:title" content=" Og  &quot;T&quot; ">'
    got = rows(p.detail_fields(pages(spark, [("a", full), ("b", only_title), ("c", None)])), "biography_url")
    assert got == [
        ("a", "Piet Hollander", "in May 1702", "?", "miller | sáilor", "He ranthe mill.", None),
        ("b", 'Og "T"', "", "", "", "", None),
        ("c", None, None, None, None, None, "no html captured")]


def test_index_links(spark):
    html = ('<div class="alphabet"><a href="/Search/Type,Biography/Initial,A/">A</a><a>none</a>'
            '<a href="/Search/Type,Biography/Initial,B/">B</a><a href="/Search/Type,Biography/Initial,A/">A</a></div>'
            '<p><a href="/Search/Type,Biography/Initial,C/">C</a><a href="/other">o</a>')
    got = rows(p.index_links(pages(spark, [(BASE, html)])).select("index_url"), "link_pos")
    assert [u[0][-2] for u in got] == ["A", "B", "C"]


def test_markup_oddities():
    def texts(html, selector, scope=None):
        return [row["v"] for row in find_values(html, Search([Rule("v", selector)], scope))]

    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul ul li") == [["c"]]
    assert texts("<script>var x='<p>no</p>'</script><p>yes", "p") == [["yes"]]
    assert texts("<div>a<script>no</script><style>no</style>b</div>", "div") == [["anonob"]]
    assert texts("<noscript><p>raw</p></noscript><p>a<!-- no -->b", "p") == [["ab"]]
    assert texts("<p>a<div>b</div>", "p") == [["a"]]
    assert texts("<a>x<a>y", "a") == [["x", "y"]]
    assert texts("<br><img class='k'>t<p class='k l'>u</p></b>", "p.k") == [["u"]]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>", "tr td") == [["1", "2", "3"]]
    assert texts('<i data-x="a,b c">q</i>', '[data-x="a,b c"], u') == [["q"]]
    assert texts("<s class=o><s class=o>in</s></s>", "", ".o") == [["in"], ["in"]]
    assert texts("<A CLASS=K>t</A>", "a.K") == [["t"]]


def test_pages_that_cannot_match_are_still_rows(spark):
    df = pages(spark, [("a", "<p>nothing here"), ("b", "<p class='birth&#68;ateText'>1900")])
    assert rows(p.detail_fields(df).select("biography_url", "biography_birth_date", "biography_error"), "biography_url") == [
        ("a", "", None), ("b", "1900", None)]
    assert p.listing_cards(df).count() == 0
    assert len(find_values('<p class="person&#73;tem">', Search([Rule("t", "")], ".personItem"))) == 1


def test_many_large_pages_keep_their_rows(spark):
    """More text than one output batch holds, and every page comes out once."""
    df = spark.range(40).select(
        F.concat(F.lit("u"), "id").alias("url"),
        F.concat(F.repeat(F.lit("<b>x</b>"), 500), F.repeat(F.lit("y"), 600_000), F.lit("<i>"), "id", F.lit("</i>"))
        .alias("html")).coalesce(1)
    got = extract(df, [Rule("n", "i"), Rule("b", "b")]).select("url", F.get("n", F.lit(0)).alias("n"), F.size("b").alias("b"))
    assert sorted((r.url, r.b) for r in got.filter("url = concat('u', n)").collect()) == sorted(
        (f"u{i}", 500) for i in range(40))


def test_hostile_pages_take_time_in_proportion():
    """Deep nesting, stray end tags and text at every depth."""
    search = [Search([Rule("t", "p")]), Search([Rule("t", ".personItem")], ".personItem")]
    n = 100_000
    for html, texts in [("<div>" * n + "<p>x", 1), ("<b>" * 4000 + "</p>" * n, 0),
                        ("<p><button>" + "<div>" * n, 1), ("<ul><li>" * n, 0), ("<p>a</p></p>" * n, n)]:
        start = time.perf_counter()
        found = find_parts(html, search)
        assert len(found[0][0]["t"]) == texts and time.perf_counter() - start < 10


def test_parsed_once_gives_what_each_operator_parses(spark):
    html = '<div class="alphabet"><a href="/Search/Type,Biography/Initial,A/">A</a></div>' + PAGER + card("/p/wren", "Olga", "1712")
    df = pages(spark, [(BASE, html), ("n", None), ("bad", html, 503), ("e", "")])
    parsed = p.parse_pages(df)
    good = df.filter("status = 200")
    for operator in (p.listing_cards, p.pager_summary, p.pager_links, p.index_links):
        assert sorted(map(str, operator(parsed).collect())) == sorted(map(str, operator(good).collect())), operator
    assert rows(p.page_errors(parsed), "url") == [("bad", "HTTP 503 for bad"), ("n", "no html captured")]
    assert parsed._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_onward(spark):
    def pager(*entries):
        return listing(entries, [])
    df = pages(spark, [("a", pager(("1", None), ("2", "p2"))), ("b", pager(("1", None), ("3", "p3"))), ("c", pager(("2", None), (">", "nx"))),
                       ("d", "<p>"), ("e", '<div class="pages"><span>1</span><a>2</a><a>&gt;</a></div>'), ("f", pager(("1", "p1"), ("2", None)))])
    got = {r.url: r.onward for r in p.pager_summary(df, onward=True).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False, "f": False}


def test_executors_need_no_copy_of_the_package():
    """The Python step still runs when Python workers cannot import this package."""
    script = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from vitarium.session import local_session\n"
        "from vitarium.operators.pages import listing_cards\n"
        "from vitarium.functions.urls import absolute_url\n"
        "spark = local_session(2)\n"
        "html = '<p class=personItem><b class=name><a href=/x>X</a></b>'\n"
        "df = spark.createDataFrame([('https://h.test/', html)], 'url string, html string')\n"
        "row = listing_cards(df).select('url', absolute_url('url', 'name').alias('two')).first()\n"
        "assert tuple(row) == ('https://h.test/x', 'https://h.test/X'), row\n"
    )
    root = pathlib.Path(__file__).parent.parent
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    subprocess.run([sys.executable, "-c", script, str(root)], cwd="/", env=environment, check=True, timeout=300)


def test_a_batch_is_let_go_before_the_next(spark):
    """A worker holds one batch of pages at a time, whatever the number of batches, and small batches of results."""
    import collections

    import pyarrow as pa

    class Captured:
        schema = spark.createDataFrame([], "url string, html string").schema

        def select(self, *columns):
            self.columns = columns
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    taken, held = Captured(), []
    extract_parts(taken, [Part("", (Rule("title", "title"),))])

    def batches():
        for n in range(3):
            held.append(pa.total_allocated_bytes())
            html = f"<title>{n}</title>" + "x" * 4_000_000
            yield pa.RecordBatch.from_pydict({c: ["u"] if c == "url" else [html] for c in taken.columns})

    collections.deque(taken.run(batches()), maxlen=0)
    assert max(held) - held[0] < 1_000_000
    long = pa.RecordBatch.from_pydict({c: ["u"] * 8 if c == "url" else ["<title>a</title>" + "x" * 600_000] * 8 for c in taken.columns})
    assert [out.num_rows for out in taken.run(iter([long]))] == [2, 2, 2, 2]
