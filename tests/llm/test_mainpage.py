import itertools
import random
import time
import tracemalloc

import pytest

from tests.llm import corpus
from vitarium.llm import mainpage as m

LONG = "The committee met on Tuesday to discuss the river, the bridge and the road that leads to the old mill. " * 3

ARTICLE = f"""<!DOCTYPE html><html><head><title>Site | T</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body class="post-template"><header class="site-header"><a href="/">Site name</a></header>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>News &amp; more</a></ul></nav>
<div class="cookie-notice">We use cookies. <button>Accept</button></div>
<div id="content"><h1>The old  mill</h1><p>{LONG}</p><p>Short one.</p><ul><li>first point</li><li>second &eacute; point</li></ul>
<!-- <p>not this</p> --><div class="ad">Buy now!</div><form><label>Mail</label><input name=x></form><p>Last &lt;word&gt;
here.</p></div>
<aside class="sidebar"><h3>Related</h3><p>Another story that is told elsewhere, with a full sentence.</p></aside>
<section id="comments"><h2>2 comments</h2><p>I liked this very much, thank you for the story of the mill.</p></section>
<footer><p>&copy; 2026 Site. All rights reserved.</p></footer></body></html>"""


def test_article_between_everything_else():
    want = f"The old mill {' '.join(LONG.split())} Short one. first point second é point Last <word> here."
    assert m.main_text(ARTICLE) == want


@pytest.mark.parametrize("page", [None, "", "<html></html>", "<script>let a = '<p>text</p>'", "<nav><a href=x>Home</a></nav>", "<!-- x"])
def test_pages_without_content(page):
    assert m.main_text(page) == ""


def test_unclosed_and_misnested_tags():
    page = "<body><nav><a>one</a><a>two</a></nav><article><h1>Head<p>First para. <b>bold<p>Second</b> para.<br>line<div>Third.</div></article><footer>foot"
    assert m.main_text(page) == "Head First para. bold Second para. line Third."


def test_quoted_angle_brackets_and_bare_ones():
    assert m.main_text('<article><p title="a > b">1 < 2 and 3 &gt; 2, he said.</p></article>') == "1 < 2 and 3 > 2, he said."


def test_very_long_page_is_whole():
    body = "".join(f"<p>Sentence number {i} of a very long article.</p>" for i in range(20_000))
    got = m.main_text(f"<nav><a>x</a></nav><article>{body}</article><footer>f</footer>")
    assert got == " ".join(f"Sentence number {i} of a very long article." for i in range(20_000))


FIRST = "The committee met on Tuesday to discuss the river, the bridge and the road that leads to the old mill, for hours and hours."
LAST = "On Wednesday it met again, since nobody had agreed on anything the day before, and this time it was the bridge that was left."
FRAMES = [
    '<div class="ad">Buy now!</div>', '<span class="ads">Buy now!</span>',
    '<div class="advertisement"><p>Buy our wonderful product now, it has never been as cheap and as good as it is today.</p></div>',
    '<section class="comments"><p>I liked this very much, thank you for the story of the mill.</p><p>So did I, and so did my aunt.</p></section>',
    '<div id="comment-list"><article class="comment"><p>Great story, I read it with joy and sent it on to all of my friends.</p></article></div>',
    '<div class="notice">We have changed our terms, please read them all with care.</div>',
    '<div class="cookie-banner"><p>We use cookies to make this site better for you and for others who read it.</p></div>',
    '<aside><h3>Related</h3><p>Another story that is told elsewhere, with a full sentence.</p></aside>',
    '<form><p>Sign up here for our letter with news about it all.</p><input><button>Go</button></form>',
    '<nav><ul><li><a href=x>Home</a></li><li><a href=y>A longer entry of the menu</a></li></ul></nav>',
    '<footer><p>Copyright by the owners of this site in the year 2026.</p></footer>',
    '<div class="social-share"><a href=x>Share this on a site</a></div>', '<div style="display: none">Not seen by anyone who reads this page.</div>',
    '<script>document.write("<p>no</p>")</script>', '<style>p { color: red }</style>', '<!-- <p>no</p> -->', '<dialog>Accept our terms.</dialog>',
]


@pytest.mark.parametrize("frame", FRAMES)
@pytest.mark.parametrize("around", ["article", "main", "article-in-form", "div-content"])
def test_frames_between_paragraphs_of_an_article(frame, around):
    begin, end = {"article": ("<article>", "</article>"), "main": ("<main>", "</main>"),
                  "article-in-form": ("<form id=all><article>", "</article></form>"),
                  "div-content": ('<div class="content has-sidebar">', "</div>")}[around]
    page = f"<body><nav><a>x</a></nav>{begin}<h1>The mill</h1><p>{FIRST}</p>{frame}<p>{LAST}</p>{end}<footer>f</footer></body>"
    assert m.main_text(page) == f"The mill {FIRST} {LAST}"


def test_names_that_only_mention_a_frame_are_none():
    page = f'<div class="page no-sidebar with-comments"><main><p>{FIRST}</p><p class="intro">{LAST}</p></main></div>'
    assert m.main_text(page) == f"{FIRST} {LAST}"


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "x", "<article>" + "<p>a</p>" * 4000 + "</p>" * 100_000, "<b>" * 4000 + "</p>" * 100_000,
    "<div>text here. " * 50_000, "<b>" * 100_000 + "<hr>t" * 100_000, "<ul><li>" * 50_000, "<p><button>" + "<div>" * 100_000,
    "<span class=ad>" * 50_000 + "x", "<a b='" * 50_000, "<" * 200_000, "<!--" * 50_000])
def test_hostile_markup_takes_time_and_memory_in_proportion(page):
    tracemalloc.start()
    begun = time.perf_counter()
    m.main_text(page)
    spent, (_, most) = time.perf_counter() - begun, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert spent < 20 and most < 400 << 20


def cost(label, source, sink, links):
    return sum(sink[i] if label[i] else source[i] for i in range(len(label))) + sum(
        c for a, b, c in links if label[a] != label[b])


@pytest.mark.parametrize("seed", range(150))
def test_cut_is_minimal(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    source = [rng.choice([0, 0, rng.random() * 4]) for _ in range(n)]
    sink = [rng.random() * 4 if s == 0 else 0 for s in source]
    links = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]
    got = cost(m.minimum_cut(source, sink, links), source, sink, links)
    assert got == pytest.approx(min(cost(x, source, sink, links) for x in itertools.product([False, True], repeat=n)))


def test_neighbours_decide_unclear_blocks():
    assert m.minimum_cut([3, 0, 3], [0, 0.5, 0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True, True, True]
    assert m.minimum_cut([0, 0.5, 0], [3, 0, 3], [(0, 1, 1.0), (1, 2, 1.0)]) == [False, False, False]


def test_operator(spark):
    rows = [(1, "u1", ARTICLE, "x"), (2, None, None, "y"), (None, "u3", "", "z"), (1, "u1", ARTICLE, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = corpus.rows_of(m.extract(df))
    text = m.main_text(ARTICLE)
    assert got == sorted([(1, "u1", text, len(text)), (2, None, "", 0), (None, "u3", "", 0), (1, "u1", text, len(text))], key=repr)
    assert m.extract(df.limit(0)).count() == 0
