import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tests.llm import corpus
from vitarium.llm import simhash
from vitarium.llm.components import components


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    pieces = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance=3):
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_fingerprints():
    texts = corpus.texts()
    assert simhash.fingerprints_of(pa.array(texts), 3).tolist() == [brute_print(t) for t in texts]


def test_components_and_representatives(spark):
    rows = corpus.rows()
    got = simhash.near_duplicates(corpus.frame(spark)).collect()
    prints = [brute_print(r[1]) for r in rows]
    group = brute_groups(set(prints))
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[group[p]] = min(i, least.get(group[p], i))
    want = sorted(((i, f"{p:016x}", least.get(group[p])) for (i, *_), p in zip(rows, prints)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    kept = simhash.representatives(corpus.frame(spark)).collect()
    assert len(kept) == len(set(group.values()))
    assert {r.doc_id for r in kept} - {None} == set(least.values())
    assert simhash.representatives(corpus.empty(spark)).count() == 0


def close_codes(n, seed):
    rng = random.Random(seed)
    codes = {rng.getrandbits(64) for _ in range(n)}
    for c in list(codes)[: n // 3]:
        for _ in range(rng.randint(1, 3)):
            c ^= 1 << rng.randrange(64)
            codes.add(c)
    return codes | {0, 1, 3, 2**64 - 1}


def test_tiles_find_every_pair():
    codes = np.array(sorted(close_codes(1500, 1)), np.uint64)
    found = {tuple(p) for block in simhash.close_pairs(codes, codes[:700], 3) for p in block.tolist()}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :700])
    assert found == {tuple(p) for p in np.argwhere(apart <= 3).tolist()}


def test_index_over_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 32)
    monkeypatch.setattr(simhash, "FAN", 4)
    codes = close_codes(900, 2)
    df = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c,) for c in codes], "fp bigint").repartition(5)
    found = components(simhash.links(df), "a", "b").collect()
    mine = {c: c for c in codes} | {r.node % 2**64: r.component % 2**64 for r in found}
    pairs = lambda of: {frozenset(c for c in of if of[c] == g) for g in set(of.values())}
    assert pairs(mine) == pairs(brute_groups(codes))


def test_gray_order_changes_one_bit_at_a_time(spark):
    df = spark.range(256).withColumn("rank", simhash.gray_rank(F.col("id"))).orderBy("rank")
    ids = [r.id for r in df.collect()]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(ids, ids[1:]))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 150)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {i: 1 for i in range(2, 61)} | {i: 100 for i in [*range(101, 160), 200]}
