"""Secret scan: keywords by Aho-Corasick, anchored patterns near hits, checksums last.

Keywords are searched in the ASCII-lower-cased bytes of a text; only where one stands is
its pattern tried, anchored there.  Long hex runs have no keyword: every eighth byte is
looked at, and a run of 24 has three such bytes in a row, so only those places are read.
Tokens that carry a checksum count only if it is right.

A null or empty text has no spans.  Spans count code points, end exclusive.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium.llm.arrow import flat_texts, map_texts
from vitarium.llm.tokens import worker_cache

#: Kinds in the order of their ties; the first three are the base.
KINDS = ["assign", "access", "hex", "github", "npm"]
BASE = KINDS[:3]
HEX_RUN = 24
STRIDE = 8
#: Alphabet of the base-62 checksums in prefixed tokens.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
MASK = "[SECRET]"

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")

#: Keyword, lower case -> kind.
KEYWORDS = {
    "password": 0, "passwd": 0, "secret": 0, "token": 0, "api_key": 0, "apikey": 0, "akia": 1,
    "ghp_": 3, "gho_": 3, "ghu_": 3, "ghs_": 3, "ghr_": 3, "npm_": 4,
}


def checksum(body: bytes) -> bytes:
    """Six base-62 digits of the CRC-32."""
    value, digits = zlib.crc32(body), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits.encode()


def _assign(raw: bytes, at: int) -> tuple[int, bool]:
    m = ASSIGN.match(raw, at)
    return (m.end(), len(m[2]) >= 6) if m else (-1, False)


def _access(raw: bytes, at: int) -> tuple[int, bool]:
    m = ACCESS.match(raw, at)
    return (m.end(), m.end() - at >= 20) if m else (-1, False)


def _checked(raw: bytes, at: int) -> tuple[int, bool]:
    m = CHECKED.match(raw, at)
    return (m.end(), checksum(m[1]) == m[2]) if m else (-1, False)


PATTERNS = {0: _assign, 1: _access, 3: _checked, 4: _checked}


def _automaton():
    import ahocorasick

    cache = worker_cache()
    if "secrets" not in cache:
        found = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            found.add_word(word, (kind, len(word)))
        found.make_automaton()
        cache["secrets"] = found
    return cache["secrets"]


def _hex_places(data: np.ndarray) -> np.ndarray:
    """Byte places that lie in a run of 17 hex digits at least; each run of 24 has one."""
    table = np.zeros(256, bool)
    table[[*range(48, 58), *range(97, 103)]] = True
    seen = table[data[::STRIDE]]
    if len(seen) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(seen[:-2] & seen[1:-1] & seen[2:]) * STRIDE
    for step in (4, 12, *(k for k in range(1, 16) if k % 4)):
        at = at[table[data[at + step]]]
    return at


def find(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """Per text (start, kind, end) in code points, in order."""
    data, starts = flat_texts(texts)
    automaton = _automaton()
    hexes: dict[int, list[int]] = {}
    region = data[starts[0]:starts[-1]]
    for at in (_hex_places(region) + starts[0]).tolist():
        hexes.setdefault(int(np.searchsorted(starts, at, "right")) - 1, []).append(at)
    out = []
    for row, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        raw = data[a:b].tobytes()
        spans = _by_keyword(raw, automaton)
        last = 0
        for at in hexes.get(row, ()):
            if at - a >= last:
                begin, last = _hex_run(raw, at - a)
                if last - begin >= HEX_RUN:
                    spans.append((begin, 2, last))
        out.append(_code_points(raw, sorted(spans)) if spans else [])
    return out


def _by_keyword(raw: bytes, automaton) -> list[tuple[int, int, int]]:
    over, spans = dict.fromkeys(PATTERNS, 0), []
    for end, (kind, length) in automaton.iter(raw.lower().decode("latin-1")):
        at = end + 1 - length
        if at >= over[kind]:
            to, good = PATTERNS[kind](raw, at)
            if to >= 0:
                over[kind] = to
                if good:
                    spans.append((at, kind, to))
    return spans


HEX = re.compile(rb"[0-9a-f]+")
BACK = re.compile(rb"[0-9a-f]+")


def _hex_run(raw: bytes, at: int) -> tuple[int, int]:
    begin = at
    while begin:  # back in strides: the run may be long
        low = max(0, begin - 256)
        tail = BACK.match(raw[low:begin][::-1])
        begin -= tail.end() if tail else 0
        if begin > low:
            break
    return begin, HEX.match(raw, at).end()


def _code_points(raw: bytes, spans):
    if raw.isascii():
        return spans
    count = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    return [(int(count[a]), kind, int(count[b])) for a, kind, b in spans]


def scan(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end) by start, then kind."""
    def step(texts: pa.Array) -> list:
        return [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in find(texts)]]

    return map_texts(df, [id_column], text, [("spans", SPANS)], step)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``df``; every secret in the texts replaced by ``MASK``, nulls kept."""
    columns = df.columns
    others = [c for c in columns if c != text]

    def step(texts: pa.Array) -> list:
        return [[_masked(t, spans) if spans else t for t, spans in zip(texts.to_pylist(), find(texts))]]

    return map_texts(df, others, text, [(text, "string")], step).select(*(f"`{c}`" for c in columns))


def _masked(text: str, spans) -> str:
    parts, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            parts += [text[at:a], MASK]
        at = max(at, b)
    return "".join(parts) + text[at:]


def spans_text(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
