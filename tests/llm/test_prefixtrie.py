import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from vitarium.llm import prefixtrie as pt, queries
from vitarium.sources.files import folders

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, words string"


def plain(rows):
    """The contract in plain Python."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0], t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = own.get(conv - (conv % 20 if conv >= 0 else -((-conv) % 20)), [])
        built[conv] = [t[1:] for t in base[:h]] + [t[1:] for t in turns[h:]]
    nodes = {}
    for conv, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(conv)
    kids = {}
    for node in nodes:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def words(text):
        return len(re.findall("[^\x20\x09-\x0d]+", text))
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids.get(node, ())) or 1
        saved[node] = sum(saved[k] for k in kids.get(node, ())) + ((len(nodes[node]) - 1) * words(node[-1][1]) if node else 0)
    return sorted(((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids.get(n, ())), leaves[n], saved[n], hashlib.sha256(
        ",".join(str(c) for c in sorted(m) if len(built[c]) == len(n)).encode()).hexdigest()) for n, m in nodes.items()), key=repr)


def trie(spark, rows, monkeypatch=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(queries, "_table", lambda *_: df)
    return sorted((tuple(r) for r in queries.op13_prefixtrie(spark, "").collect()), key=repr)


def made(seed, n=120, deep=()):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        first = rng.choice(["hello there", "good day to you", "x"])
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", first if t == 0 else rng.choice(["yes", "no  no", "a b c"]), 1, ""))
    for c, length in enumerate(deep, n):
        rows += [(c, t, "user", f"turn {min(t, 25)}", 1, "") for t in range(length)]
    return rows


@pytest.mark.parametrize(("seed", "deep", "part", "piece"), [(1, (), 1024, 4096), (2, (30, 30, 31, 80, 80, 81, 82), 7, 3)])
def test_like_plain_python(spark, monkeypatch, seed, deep, part, piece):
    monkeypatch.setattr(pt, "PART_TURNS", part)
    monkeypatch.setattr(pt, "PIECE", piece)
    rows = made(seed, deep=deep)
    assert trie(spark, rows, monkeypatch) == plain(rows)


def test_long_shared_prefixes_take_rounds_only_where_conversations_meet(spark, monkeypatch):
    """Near copies of long conversations that part late, one inside another, and one that ends on the way."""
    rows = []
    for conv, (length, part) in enumerate([(200, 200), (200, 199), (200, 150), (90, 90), (200, 200), (40, 39), (40, 40), (3, 1)], 1):
        rows += [(conv * 20, t, "user", f"turn {t} of it" if t < part else f"own {conv} {t}", 1, "") for t in range(length)]
    rounds = []
    plain_read = pt.scratch_path
    monkeypatch.setattr(pt, "scratch_path", lambda session, name: rounds.append(plain_read(session, name)) or rounds[-1])
    assert trie(spark, rows, monkeypatch) == plain(rows)
    assert len(folders(spark, f"{rounds[-1]}/nodes")) <= 9


def test_hard_cases(spark, monkeypatch):
    rows = [
        (0, 0, "user", "a b", 1, ""), (0, 1, None, None, 1, ""), (0, None, "user", "null turn first", 1, ""), (0, 1, "", "", 1, ""),
        (1, 0, "user", "a b", 1, ""), (1, 0, "user", "a b", 1, ""), (2, 5, "user", "tie 1", 1, ""), (2, 5, "user", "tie 2", 1, ""),
        (2, 5, "bot", "tie 3", 1, ""), (None, 0, "user", "nobody", 1, ""), (-3, 0, "user", "a b", 1, ""), (-20, 0, "user", "base of -25", 1, ""),
        (-25, 0, "x", "y", 1, ""), (-25, 1, "x", "y z", 1, ""), (45, 3, "user", "no base", 1, ""), (45, 4, "user", "x" * 100_000, 1, ""),
        (9_000_000_000_000, 1, "user", "large id", 1, "")]
    rows += [(c, 0, "user", "one copy", 1, "") for c in range(100, 160)]
    assert trie(spark, rows, monkeypatch) == plain(rows)
    assert trie(spark, [(None, 1, "a", "b", 1, "")], monkeypatch) == [] == trie(spark, [], monkeypatch)
    one = [(7, 1, "a", "b", 1, "")]
    assert trie(spark, one, monkeypatch) == plain(one)


def test_conversations_without_turns_belong_to_the_root(spark):
    turns = spark.createDataFrame([(1, 1, 5, 6, 2)], "conv bigint, depth bigint, a bigint, b bigint, words bigint")
    convs = spark.createDataFrame([(1,), (2,), (3,)], "conv bigint")
    got = {r.depth: r for r in pt.prefix_trie(turns, convs).collect()}
    assert (got[0].conv, got[0].n_convs, got[0].n_children, got[0].n_leaves) == (1, 3, 1, 1)
    assert got[0].ends == hashlib.sha256(b"2,3").hexdigest() and got[1].ends == hashlib.sha256(b"1").hexdigest()
    none = pt.prefix_trie(turns.limit(0), convs).collect()
    assert [(r.conv, r.depth, r.n_convs, r.n_leaves) for r in none] == [(1, 0, 3, 1)]


def test_places_of_a_conversation_in_several_partitions(spark):
    rows = [(c, t, "r", f"text {t}", 1, "") for c in (1, 2, 3) for t in range(2000 if c == 2 else 5)]
    got = pt.ordered(spark.createDataFrame(rows, SCHEMA).repartition(6)).groupBy("conv").agg(
        F.min("place"), F.max("place"), F.count_distinct("place")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 5, 5), (2, 1, 2000, 2000), (3, 1, 5, 5)]
