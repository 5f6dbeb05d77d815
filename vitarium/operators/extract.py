"""Rule-driven extraction of values from captured pages.

Python only finds the nodes and hands back their raw texts and attributes as
arrays; cleaning, joining, ranking and reshaping are left to Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vitarium.functions.urls import resolve_url

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# An opening tag on the left ends these open elements, looking no further up than the fences.
_CELLS, _LISTS = ("table",), ("ul", "ol", "menu")
_BLOCKS = (
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul"
).split()
IMPLIED_ENDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    **{tag: (("p",), ("button", "td", "th")) for tag in _BLOCKS},
    "li": (("li",), _LISTS),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "tr": (("tr",), _CELLS),
    "td": (("td", "th"), ("tr", *_CELLS)),
    "th": (("td", "th"), ("tr", *_CELLS)),
    "a": (("a",), ("table", "button")),
}
_SIMPLE = re.compile(r"""([\w-]+|\*)|\.([\w-]+)|#([\w-]+)|\[([\w:-]+)(?:(\*?)=["']?([^"'\]]*)["']?)?\]""")


@dataclass(frozen=True)
class Rule:
    """Values of ``selector``: the text of each node or, with ``attr``, that
    attribute.  An empty selector means the scope node itself.  ``resolve``
    turns non-empty values into absolute URLs."""

    field: str
    selector: str
    attr: str | None = None
    resolve: bool = False


def compile_selector(selector: str) -> list[list[list[tuple[str, str, str]]]]:
    """Comma union of descendant chains of simple tests ``(attribute, how, value)``."""
    chains = []
    for chain in re.findall(r"""(?:[^,"']|"[^"]*"|'[^']*')+""", selector):
        steps = []
        for step in re.findall(r"""(?:[^\s"'\[]|\[[^\]]*\])+""", chain):
            tests = []
            for tag, cls, ident, attr, star, value in _SIMPLE.findall(step):
                if tag:
                    tests.append(("", "*" if tag == "*" else "=", tag.lower()))
                elif cls:
                    tests.append(("class", "word", cls))
                elif ident:
                    tests.append(("id", "=", ident))
                else:
                    how = "in" if star else "=" if "=" in step else "has"
                    tests.append((attr.lower(), how, value))
            steps.append(tests)
        chains.append(steps)
    return chains


def _passes(node: dict[str, str], tests: list[tuple[str, str, str]]) -> bool:
    for attr, how, value in tests:
        have = node.get(attr)
        if how == "*":
            continue
        if have is None or not (
            how == "has"
            or (how == "=" and have == value)
            or (how == "in" and value and value in have)
            or (how == "word" and value in have.split())
        ):
            return False
    return True


class Search:
    """Rules and scope with their selectors taken apart, once per job."""

    def __init__(self, rules: Sequence[Rule], scope: str | None = None):
        by_selector: dict[str, list[Rule]] = {}
        for rule in rules:
            by_selector.setdefault(rule.selector, []).append(rule)
        self.rules = list(rules)
        self.own_rules = by_selector.pop("", [])
        self.groups = [(compile_selector(selector), group) for selector, group in by_selector.items()]
        self.scope = compile_selector(scope) if scope else None
        chains = self.scope or [steps for group, _ in self.groups for steps in group]
        self.literals = [
            [value for tests in steps for attr, _, value in tests if attr and value.isalnum()] for steps in chains]

    def empty_row(self) -> dict[str, list]:
        return {rule.field: [] for rule in self.rules}

    def may_match(self, html: str) -> bool:
        """False only if no selector can match: each of their chains tests a class, id or
        attribute value that the page nowhere spells, not even by character number (or by
        the one character name that stands for ASCII letters)."""
        if "&#" in html or "&fjlig" in html:
            return True
        return any(all(value in html for value in values) for values in self.literals)


class _Found:
    """What one search has found on a page, and the scope nodes that are open."""

    def __init__(self, search: Search):
        self.search = search
        self.rows: list[dict[str, list]] = [] if search.scope else [search.empty_row()]
        self.scopes: list[tuple[int, dict[str, list]]] = [] if search.scope else [(-1, self.rows[0])]


class _Finder(HTMLParser):
    """One pass over a page for any number of searches: matches rules as tags open, gathers text until they close.

    The text of a node is all text below it, that of scripts and styles included.  Where a tag
    stands is looked up by its name, so tags that close nothing cost nothing, however deep the page.
    """

    CDATA_CONTENT_ELEMENTS = ("script", "style", "noscript", "iframe", "noembed", "noframes", "xmp")

    def __init__(self, searches: Sequence[Search]):
        super().__init__(convert_charrefs=True)
        self.found = [_Found(search) for search in searches]
        self.open: list[dict] = []
        self.places: dict[str, list[int]] = {}
        self.texts: list[tuple[int, list[str]]] = []

    def _matches(self, chains, node) -> bool:
        for steps in chains:
            if _passes(node, steps[-1]):
                wanted = len(steps) - 2
                for above in reversed(self.open) if wanted >= 0 else ():
                    if _passes(above, steps[wanted]):
                        wanted -= 1
                        if wanted < 0:
                            break
                if wanted < 0:
                    return True
        return False

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def _last(self, tags) -> int:
        """How deep the innermost open element of these names is; -1 without one."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    @staticmethod
    def _take(node, rules, targets, texts):
        for rule in rules:
            value = node.get(rule.attr) if rule.attr else []
            for target in targets:
                target[rule.field].append(value)
            if rule.attr is None:
                texts.append(value)

    def handle_starttag(self, tag, attrs):
        ended, fences = IMPLIED_ENDS.get(tag, ((), ()))
        if ended:
            depth = self._last(ended)
            if depth > self._last(fences):
                self._close(depth)
        node = {}
        for name, value in attrs:
            node.setdefault(name, value or "")
        node[""] = tag
        texts: list[list[str]] = []
        depth, inside = len(self.open), tag not in VOID
        for found in self.found:
            search, row = found.search, None
            if search.scope and self._matches(search.scope, node):
                row = search.empty_row()
                found.rows.append(row)
                self._take(node, search.own_rules, (row,), texts)
            if found.scopes:
                for chains, rules in search.groups:
                    if self._matches(chains, node):
                        self._take(node, rules, [scope for _, scope in found.scopes], texts)
            if row is not None and inside:
                found.scopes.append((depth, row))
        if inside:
            self.open.append(node)
            self.places.setdefault(tag, []).append(depth)
            self.texts += [(depth, text) for text in texts]

    def handle_endtag(self, tag):
        depth = self._last((tag,))
        if depth >= 0:
            self._close(depth)

    def _close(self, depth: int):
        for node in self.open[depth:]:
            self.places[node[""]].pop()
        del self.open[depth:]
        while self.texts and self.texts[-1][0] >= depth:
            self.texts.pop()
        for found in self.found:
            while found.scopes and found.scopes[-1][0] >= depth:
                found.scopes.pop()

    def handle_data(self, data):
        for _, text in self.texts:
            text.append(data)


def find_parts(html: str, searches: Sequence[Search], base: str | None = None) -> list[list[dict[str, list[str | None]]]]:
    """Rows of one page for each search, from one pass over it; one row per scope node, or a single one without a scope."""
    able = [search for search in searches if search.may_match(html)]
    if able:
        finder = _Finder(able)
        finder.feed(html)
        finder.close()
        for found in finder.found:
            for row in found.rows:
                for rule in found.search.rules:
                    values = ["".join(v) if isinstance(v, list) else v for v in row[rule.field]]
                    if rule.resolve:
                        values = [resolve_url(base, v) if v else v for v in values]
                    row[rule.field] = values
        able = {id(found.search): found.rows for found in finder.found}
    return [able[id(s)] if able and id(s) in able else [] if s.scope else [s.empty_row()] for s in searches]


def find_values(html: str, search: Search, base: str | None = None) -> list[dict[str, list[str | None]]]:
    """Rows of one page for one search."""
    return find_parts(html, [search], base)[0]


#: Upper bound on the HTML characters whose results sit in one output batch.
BATCH_CHARS = 1_000_000


@dataclass(frozen=True)
class Part:
    """One kind of rows to take from a page: its rules and, optionally, the node each row is about."""

    name: str
    rules: tuple[Rule, ...]
    scope: str | None = None


def extract(pages: DataFrame, rules: Sequence[Rule], *, scope: str | None = None,
            keep: Sequence[str] = ("url",), html: str = "html", base: str | None = None) -> DataFrame:
    """Applies the rules to every page.

    Gives ``keep`` columns, ``scope_pos`` (place of the scope node on its page, 0
    without a scope), one ``array<string>`` per field, and ``extract_error``.  A
    page that cannot be read gives one row with ``scope_pos`` NULL and the error.
    ``base`` names the column URLs are resolved against (default: ``url``).
    """
    return extract_parts(pages, [Part("", tuple(rules), scope)], keep=keep, html=html, base=base).drop("part")


def extract_parts(pages: DataFrame, parts: Sequence[Part], *, keep: Sequence[str] = ("url",), html: str = "html",
                  base: str | None = None) -> DataFrame:
    """Applies several sets of rules to every page in one pass over it.

    Gives ``keep`` columns, ``part`` (whose row it is), ``scope_pos``, one ``array<string>`` per field of any
    part, NULL in rows of parts without it, and ``extract_error``.  A page that cannot be read
    gives one row in all, with ``part`` and ``scope_pos`` NULL and the error.
    """
    keep, parts = list(keep), list(parts)
    base = base or "url"
    names = list(dict.fromkeys(rule.field for part in parts for rule in part.rules))
    resolves = any(rule.resolve for part in parts for rule in part.rules)
    columns = [*dict.fromkeys([*keep, *([base] if resolves else []), html])]
    kept = [pages.schema[c] for c in keep]
    schema = T.StructType(
        kept
        + [T.StructField("part", T.StringType()), T.StructField("scope_pos", T.IntegerType())]
        + [T.StructField(name, T.ArrayType(T.StringType())) for name in names]
        + [T.StructField("extract_error", T.StringType())]
    )
    strings = pa.list_(pa.string())
    tags = [part.name for part in parts]
    searches = [Search(part.rules, part.scope) for part in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, kinds, places, errors, size = [], [], [], [], 0
            fields: dict[str, list] = {name: [] for name in names}

            def flush():
                rows = batch.select(keep).take(pa.array(source, pa.int64()))
                arrays = [pa.array(kinds, pa.string()), pa.array(places, pa.int32())]
                arrays += [pa.array(fields[name], strings) for name in names]
                arrays.append(pa.array(errors, pa.string()))
                return pa.RecordBatch.from_arrays([*rows.columns, *arrays], names=schema.names)

            bases = batch.column(base) if base in batch.schema.names else None
            for index, page in enumerate(batch.column(html)):
                text = page.as_py()
                try:
                    if text is None:
                        raise ValueError("no html captured")
                    found = find_parts(text, searches, bases[index].as_py() if bases is not None else None)
                    rows = [(tag, place, row, None) for tag, of in zip(tags, found) for place, row in enumerate(of)]
                except Exception as problem:  # a bad page must not fail the job
                    rows = [(None, None, {}, str(problem) or type(problem).__name__)]
                for tag, place, row, error in rows:
                    source.append(index)
                    kinds.append(tag)
                    places.append(place)
                    errors.append(error)
                    for name in names:
                        fields[name].append(row.get(name))
                size += len(text or "")
                if size >= BATCH_CHARS:
                    yield flush()
                    source, kinds, places, errors, size = [], [], [], [], 0
                    fields = {name: [] for name in names}
            if source:
                yield flush()
            # nothing of a batch outlives it: the next one is read into memory that is free again
            batch = bases = page = text = found = rows = row = source = kinds = places = errors = fields = None
            pa.default_memory_pool().release_unused()

    return pages.select(*columns).mapInArrow(run, schema)
