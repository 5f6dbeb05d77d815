import re
import zlib

import pyarrow as pa
import pytest

from tests.llm import corpus
from vitarium.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans_equal_plain_patterns(spark):
    got = secrets.scan(corpus.frame(spark)).collect()
    want = sorted([(i, [(secrets.KINDS[k], a, b) for a, k, b in brute(t or "")]) for i, t, *_ in corpus.rows()], key=repr)
    assert sorted([(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in got], key=repr) == want
    assert sum(len(w[1]) for w in want) >= 8


def test_hex_runs_of_every_length_and_place():
    texts = ["é" * a + "z" + "a1" * n + "f" * (n % 2) + tail for a in range(9) for n in range(10, 15) for tail in ("", "g", "é")]
    assert secrets.find(pa.array(texts)) == [brute(t) for t in texts]


@pytest.mark.parametrize("prefix", ["ghp", "ghs", "npm"])
def test_checksums_decide(prefix):
    body = b"A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"{prefix}_{body.decode()}{secrets.checksum(body).decode()}"
    bad = good[:-1] + ("x" if good[-1] != "x" else "y")
    kind = secrets.KINDS.index("npm" if prefix == "npm" else "github")
    assert secrets.find(pa.array([f"é {good}.", f"é {bad}.", good + "Q"])) == [[(2, kind, 2 + len(good))], [], []]
    assert zlib.crc32(body) == sum(62 ** (5 - i) * secrets.BASE62.index(c) for i, c in enumerate(
        secrets.checksum(body).decode()))


def test_redaction_masks_and_keeps_everything_else(spark):
    df = corpus.frame(spark)
    out = secrets.redact(df)
    assert out.columns == df.columns and out.count() == df.count()
    for r in out.filter("text is not null").collect():
        assert not brute(r.text), r.text[:80]
    clean = {(r[0], r[1]) for r in corpus.rows() if not brute(r[1] or "")}
    assert clean <= {(r.doc_id, r.text) for r in out.collect()}
    assert secrets.redact(corpus.empty(spark)).count() == 0
