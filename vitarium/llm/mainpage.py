"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks at block-level tags.  A linear classifier over what stands around a
block (tags, class and id names above it, links, length, punctuation) says how likely it is
content; its two costs are the capacities to source and sink.  Neighbours in page order, and
blocks under one parent, are joined by smoothness edges, weaker the further apart they stand
in the tree.  The minimum cut labels all blocks of a page together: a short paragraph inside
an article stays, a lone line between menus goes.

Of what stands above a block the nearest says most.  A menu, advert, notice, comment section or form
begins a frame: what made the surroundings content no longer counts in it, and no edge joins it
to what lies outside.  ``main`` begins content again, whatever it stands in, and so does an
``article`` in a form, which some sites put around the whole page.

Work and memory grow with the page and not with its depth: elements know their parent, and the innermost
open element of a name is looked up, not searched for.

Scripts, styles, forms, comments and markup are never text.  Character references are decoded,
white space within a block becomes one space, blocks are joined by one.  Nothing else is
dropped and nothing is capped; a null or empty page, or one without content, has empty text.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitarium.llm.arrow import map_texts

#: Fixed lists of HTML: elements without end tags, elements whose content is no text, elements that
#: break a line of text, and elements that a paragraph's start closes or ends with.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas textarea select".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - frozenset("option td th tr tbody thead tfoot caption body html title summary".split())
SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
P_FENCES = ("article", "section", "div", "td", "th", "li", "table", "button")
SCOPE = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",)}

#: Weights of the classifier, for content; a block starts at ``bias``.
WEIGHTS = {"bias": 0.2, "content element": 3.0, "content name": 1.5, "frame element": -6.0, "frame name": -4.0,
           "head": -9.0, "heading in content": 1.0, "paragraph": 0.8, "list item": -0.3, "link share": -2.5,
           "short": -0.6, "long": 1.0, "sentence": 0.6}
CONTENT = frozenset(("article", "main"))
FRAME = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button"))
FRAME_NAMES = re.compile(
    r"(?:^|[^a-z])(?:nav\w*|menu\w*|header|masthead|foot\w*|side-?bar\w*|aside|ads?|advert\w*|adsense|banner\w*|promo\w*|"
    r"sponsor\w*|cookies?|consent|notice\w*|alert\w*|popup|modal|gdpr|subscri\w*|newsletter|share\w*|sharing|social\w*|"
    r"comments?|comment-\w+|respon[ds]e?s?|disqus|reply|replies|related\w*|recommend\w*|breadcrumbs?|pagination|pager|widget\w*|"
    r"login|signup|search\w*|toolbar|copyright|legal|disclaimer|tags?-?list|form)(?:$|[^a-z])")
CONTENT_NAMES = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|post|post-body|entry\w*|story\w*|text|body)(?:$|[^a-z])")
#: Names that only say what else a page has.
MODIFIERS = re.compile(r"(?:^|(?<=[^a-z]))(?:has|with|without|no|show|hide|is)-[\w-]+")
#: Capacity of an edge between neighbours under one parent, and how it falls per step apart in the tree.
SMOOTH, FALL = 1.2, 0.5
#: Edge between successive blocks of one parent that are not neighbours in the page.
PROXIMITY = 0.4

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|[\s"'])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)


@dataclass(slots=True, eq=False)
class Node:
    """An open element: its tag, the block-level element it lies in (or is), and what it and those above it say.

    ``frame_at`` is the innermost frame's element, ``depth`` counts block-level elements above.
    """

    tag: str
    above: "Node | None"
    block: "Node | None" = None
    frame_at: "Node | None" = None
    depth: int = 0
    content: bool = False
    frame: bool = False
    content_name: bool = False
    frame_name: bool = False
    link: bool = False


@dataclass(slots=True)
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _child(parent: Node, tag: str, attributes: str) -> Node:
    names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes)).lower() if "=" in attributes else ""
    names = MODIFIERS.sub(" ", names)
    inside = parent.content or parent.content_name
    # headers and the like within an article belong to it; what they name otherwise does not
    element = (tag in FRAME and not (tag == "header" and inside)) or bool(attributes and HIDDEN.search(attributes))
    named = bool(names and FRAME_NAMES.search(names) and tag not in ("body", "html", "article", "main"))
    node = Node(tag, parent.block, None, parent.frame_at, parent.block.depth, parent.content, parent.frame, parent.content_name,
                parent.frame_name, parent.link or tag == "a")
    if element or named:
        node.frame_at, node.content, node.content_name = node, False, False
        node.frame, node.frame_name = parent.frame or element, parent.frame_name or named
    elif tag == "main" or (tag == "article" and (parent.frame_at is None or parent.frame_at.tag == "form")):
        node.frame_at, node.content, node.frame, node.frame_name = None, True, False, False
    elif names and node.frame_at is None and CONTENT_NAMES.search(names):
        node.content_name = True
    if tag in BLOCK:
        node.block, node.depth = node, node.depth + 1
    else:
        node.block = parent.block
    return node


class _Open:
    """The open elements, and for each name where they stand."""

    def __init__(self):
        root = Node("", None)
        root.block = root
        self.stack, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def innermost(self, tags, stop=()) -> int:
        """Where the innermost element of these names stands, 0 if there is none or one of ``stop`` lies further in."""
        at = max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)
        return at if at > max((self.places[t][-1] for t in stop if self.places.get(t)), default=0) else 0

    def close(self, at: int) -> bool:
        """Closes elements from place ``at``; whether one of them was block-level."""
        blocks = False
        for node in self.stack[at:]:
            self.places[node.tag].pop()
            blocks = blocks or node.tag in BLOCK
        del self.stack[at:]
        return blocks


def blocks(page: str) -> list[Block]:
    """Runs of text between block-level tags, in page order."""
    open_, out = _Open(), []
    current: Block | None = None
    at = 0

    def say(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        inner = open_.stack[-1]
        if current is None:
            if raw.isspace():
                return
            current = Block(inner.block)
            out.append(current)
        current.parts.append(raw)
        if inner.link:
            current.linked += len(raw.strip())

    while True:
        m = TOKEN.search(page, at)
        if not m:
            break
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            found = open_.innermost((tag,))
            if (open_.close(found) if found else tag in BLOCK):
                current = None
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if not (m[3].endswith("/") and tag in ("svg", "math")):
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCK:
            current = None
        if tag in VOID:
            continue
        for ended, stop in (((("p",), P_FENCES),) if tag in CLOSES_P else ()) + (((SAME[tag], SCOPE[tag]),) if tag in SAME else ()):
            found = open_.innermost(ended, stop)
            if found and open_.close(found):
                current = None
        inner = _child(open_.stack[-1], tag, m[3])
        if inner.frame_at is not open_.stack[-1].frame_at:
            current = None  # a frame's text is its own, also where the frame is no block
            if inner.frame_at is inner and tag not in BLOCK:
                inner.block, inner.depth = inner, inner.depth + 1
        open_.push(inner)
    say(page[at:])
    return [b for b in out if b.text()]


def log_odds(block: Block, text: str) -> float:
    """Above zero: rather content."""
    w, node = WEIGHTS, block.node
    if node.tag == "title":
        return w["head"]
    score = w["bias"]
    score += w["content element"] * node.content + w["content name"] * node.content_name
    score += w["frame element"] * node.frame + w["frame name"] * node.frame_name
    score += w["heading in content"] * (node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
    score += w["paragraph"] * (node.tag in ("p", "blockquote", "pre", "td")) + w["list item"] * (node.tag == "li")
    score += w["link share"] * min(1.0, block.linked / max(1, len(text)))
    score += w["short"] * (len(text) < 30) + w["long"] * (len(text) > 200)
    return score + w["sentence"] * (text[-1:] in ".!?…:\"”»")


def _apart(a: Node, b: Node) -> int:
    """Steps between two block-level elements: the longer way up to the element that holds both."""
    x, y = a, b
    while x.depth > y.depth:
        x = x.above
    while y.depth > x.depth:
        y = y.above
    while x is not y:
        x, y = x.above, y.above
    return max(a.depth, b.depth) - x.depth


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness: successive blocks, by their distance in the tree; then successive ones of one parent.

    None leads from a frame to what lies outside of it.
    """
    out: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i and found[i - 1].node.frame_at is b.node.frame_at:
            out.append((i - 1, i, SMOOTH * FALL ** max(0, min(64, _apart(found[i - 1].node, b.node) - 1))))
        parent = id(b.node.above)
        before = last.get(parent, i)
        if before < i - 1 and found[before].node.frame_at is b.node.frame_at:
            out.append((before, i, PROXIMITY))
        last[parent] = i
    return out


def minimum_cut(source: list[float], sink: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source side of a minimum cut (of several the one with the fewest).

    A node whose own costs outweigh all its edges has its label in every minimum cut; such nodes are
    taken out first and their edges folded into their neighbours' costs, over and over.  What is left
    goes through a maximum flow.
    """
    n = len(source)
    pull = [s - t for s, t in zip(source, sink)]
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in links:
        if a != b and c > 0:
            near[a][b] = near[a].get(b, 0.0) + c
            near[b][a] = near[b].get(a, 0.0) + c
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None:
            continue
        room = sum(near[i].values())
        if abs(pull[i]) > room or not near[i]:
            label[i] = pull[i] > 0
            for j, c in near[i].items():
                pull[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _flow([pull[i] for i in rest], rest, near)):
            label[i] = side
    return [bool(x) for x in label]


def _flow(pull: list[float], names: list[int], near: list[dict[int, float]]) -> list[bool]:
    """Source side after a maximum flow by shortest augmenting paths."""
    at = {name: k for k, name in enumerate(names)}
    n = len(names)
    s, t = n, n + 1
    room: list[dict[int, float]] = [{} for _ in range(n + 2)]
    for k, name in enumerate(names):
        for other, c in near[name].items():
            room[k][at[other]] = c
        if pull[k] > 0:
            room[s][k], room[k][s] = pull[k], 0.0
        elif pull[k] < 0:
            room[k][t], room[t][k] = -pull[k], 0.0
    tiny = 1e-9
    while True:
        before = {s: s}
        queue = deque([s])
        while queue and t not in before:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > tiny and j not in before:
                    before[j] = i
                    queue.append(j)
        if t not in before:
            return [k in before for k in range(n)]
        path, j = [], t
        while j != s:
            path.append((before[j], j))
            j = before[j]
        flow = min(room[i][j] for i, j in path)
        for i, j in path:
            room[i][j] -= flow
            room[j][i] = room[j].get(i, 0.0) + flow


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    texts = [b.text() for b in found]
    odds = [log_odds(b, t) for b, t in zip(found, texts)]
    keep = minimum_cut([max(0.0, x) for x in odds], [max(0.0, -x) for x in odds], edges(found))
    return " ".join(t for t, k in zip(texts, keep) if k)


def extract(df: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep``, the main text and its length in code points."""
    def step(pages: pa.Array) -> list:
        return [[main_text(p) for p in pages.to_pylist()]]

    return map_texts(df, list(keep), html_column, [("text", "string")], step).withColumn(
        "n_chars", F.length("text").cast("long"))
