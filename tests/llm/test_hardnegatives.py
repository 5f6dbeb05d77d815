import numpy as np
import pytest
from pyspark.sql import functions as F

from vitarium.llm import hardnegatives as hn

SCHEMA = "vec_id bigint, label int, vector array<bigint>, score bigint, rank string"


def brute(rows, least=50, most=95):
    """Every pair, in plain Python."""
    rows = [(i, lab, [int(v) for v in vec]) for i, lab, vec, *_ in rows
            if i is not None and lab is not None and vec is not None and None not in vec and sum(v * v for v in vec) < 2 ** 53]
    out = []
    for a, (anchor, label, vector) in enumerate(rows):
        if anchor % 5:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, other)), i, lab) for b, (i, lab, other) in enumerate(rows) if b != a)
        for s, positive in [(-s, i) for s, i, lab in scored if lab == label][:5]:
            fits = [(i, -n) for n, i, lab in scored if lab != label and least * s <= -100 * n <= most * s][:3]
            out += [(anchor, positive, rank, i, s, n) for rank, (i, n) in enumerate(fits, 1)]
    return sorted(out)


def mined(df):
    got = hn.hard_negatives(df, F.col("vec_id") % 5 == 0)
    return sorted(tuple(r)[:6] for r in got.collect())


def made(seed, n=160, dims=12, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(5, dims)) * 40
    return [(i, int(rng.integers(labels)), [int(v) for v in centre[rng.integers(5)] + rng.normal(size=dims) * 25], 1, "x") for i in range(n)]


@pytest.mark.parametrize(("seed", "cells", "anchors"), [(1, 1 << 18, 1024), (2, 200, 7), (3, 600, 1024)])
def test_like_every_pair(spark, monkeypatch, seed, cells, anchors):
    monkeypatch.setattr(hn, "BLOCK_CELLS", cells)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", anchors)
    rows = made(seed)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_hard_cases(spark):
    rows = made(4, 60)
    rows += [(5, 1, [0] * 12, 1, "zero"), (10, 2, [], 1, "no components"), (15, 1, [3, 4], 1, "short"), (20, None, [1] * 12, 1, ""),
             (25, 1, None, 1, ""), (30, 1, [None, 1], 1, ""), (None, 1, [1] * 12, 1, ""), (35, 1, [1 << 30, 1], 1, "too large"),
             rows[10], rows[10], rows[7], (40, 9, [5] * 12, 1, "alone with its label"), (7, 3, rows[7][2], 1, "same id, other label")]
    rows += [(100 + i, 5, [7, -7] * 6, 1, "ties") for i in range(12)] + [(200 + i, 6, [5, -7] * 6, 1, "ties") for i in range(12)]
    want = brute(rows)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(4)) == want and want
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(5, 1, [1], 1, "")], SCHEMA)) == []


@pytest.mark.parametrize("least", [-np.inf, -500.0, 0.0, 900.0, 2500.0, 1e9])
def test_join_finds_all_that_reach_the_threshold(least):
    rng = np.random.default_rng(5)
    x, asked = (np.floor(rng.normal(size=(n, 20)) * 12) for n in (300, 40))
    found = [p for p in hn.join(x, asked, np.full(40, least))]
    pairs = {(int(a), int(b)): int(s) for p in found for a, b, s in zip(*p)}
    truth = asked @ x.T
    assert pairs == {(a, b): int(truth[a, b]) for a, b in np.argwhere(truth >= least)}
    assert sum(len(p[0]) for p in found) == len(pairs)


def test_index_leaves_out_what_the_norm_bound_covers():
    """Rows too short for the threshold are never looked at; others only by their leading dimensions."""
    x = np.array([[100.0, 1, 1], [1, 1, 1], [90, 2, 0]])
    rest = hn._rest(x)
    assert ((rest >= 50).sum(axis=1) == [1, 0, 1]).all()


def test_quantised_rounds_down_and_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([None],), ([float("inf")],), (None,), ([],)], "v array<float>")
    got = [r[0] for r in df.select(hn.quantised(F.col("v"))).collect()]
    assert got == [[128, -1], None, None, None, None, []]
