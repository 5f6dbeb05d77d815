import numpy as np
import pytest

from vitarium.llm import neargraph


def vectors(seed, n=500, group=120, d=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    base = rng.normal(size=(8, d))
    near = [b + rng.normal(size=(k, d)) * 0.08 for b, k in zip(base, (group, 20, 7, 3, 2, 2, 2, 2))]
    chain = [np.cos(t) * base[0] / np.linalg.norm(base[0]) + np.sin(t) * np.eye(d)[3] for t in np.arange(0, 2, 0.3)]
    return np.concatenate([x, *near, chain, x[:5], 1e200 * x[5:8], 1e-200 * x[8:10]])


def brute(x, ids, least=0.9):
    unit = neargraph.unit(x)
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    root = list(range(len(x)))
    for i, j in np.argwhere(close):
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        root[max(i, j)] = min(i, j)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    return {ids[i]: (int(close[i].sum()), ids[find(i)]) for i in range(len(x))}


@pytest.mark.parametrize(("rows", "limit"), [(1500, 6000), (120, 6000), (300, 60)])
def test_links_and_components(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(neargraph, "SHARD_ROWS", rows)
    monkeypatch.setattr(neargraph, "SHARD_LIMIT", limit)
    x = vectors(rows)
    ids = list(range(100, 100 + len(x)))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in neargraph.near_duplicates(df.repartition(4)).collect()}
    want = brute(x, ids)
    assert got.keys() == want.keys()
    found, true = sum(r.n_links for r in got.values()), sum(n for n, _ in want.values())
    assert all(got[i].n_links <= want[i][0] for i in ids)
    assert found >= 0.98 * true and min(r.audit_recall for r in got.values()) > 0.95
    assert sum(got[i].component_id == want[i][1] for i in ids) >= 0.98 * len(ids)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_search_in_one_shard_finds_dense_groups():
    x = neargraph.unit(vectors(7, 300, 400))
    a, b = neargraph.search(x, neargraph.build_graph(x), x, neargraph.BEAM, 0.9)
    want = (x @ x.T >= 0.9).sum()
    assert len(set(zip(a.tolist(), b.tolist()))) == len(a) <= want
    assert len(a) >= 0.995 * want


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [1.0, None], [1.0, 2.0, 3.0], [1.0]]  # the last two have no other vector of their length
    rows = [(i, v) for i, v in enumerate(odd)] + [(10, [1.0, 1.0]), (11, [2.0, 2.0]), (11, [2.0, 2.0]), (None, [1.0, 1.01]),
                                                 (12, [-1.0, 1.0]), (13, [1.0, 0.0]), (13, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted((tuple(r)[:4] for r in neargraph.near_duplicates(df).collect()), key=repr)
    want = [(i, 0, i, True) for i in range(8)] + [(10, 3, 10, True), (11, 3, 10, False), (11, 3, 10, False), (None, 3, 10, False),
                                                  (12, 0, 12, True), (13, 0, 13, True), (13, 0, 13, True)]
    assert got == sorted(want, key=repr)
    assert neargraph.near_duplicates(df.limit(0)).count() == 0
    assert neargraph.near_duplicates(df.filter("vec_id < 5")).count() == 5


def frame(spark, vectors, parts=4):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(parts)


def pairs_apart(rng, n, d, cosine):
    """``n`` pairs that link with each other only."""
    a = neargraph.unit(rng.normal(size=(n, d)))
    b = rng.normal(size=(n, d))
    b = neargraph.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    return np.stack([a, cosine * a + np.sqrt(1 - cosine ** 2) * b], axis=1).reshape(2 * n, d)


def test_a_dense_group_hides_no_lost_pairs(spark, monkeypatch):
    """What the audit says is what brute force says, vector by vector."""
    monkeypatch.setattr(neargraph, "SHARD_ROWS", 300)
    rng = np.random.default_rng(3)
    d = 48
    dense = neargraph.unit(rng.normal(size=d) + rng.normal(size=(700, d)) * 0.05)
    x = np.concatenate([dense, pairs_apart(rng, 700, d, 0.905)])
    got = {r.vec_id: r for r in neargraph.near_duplicates(frame(spark, x)).collect()}
    unit = neargraph.unit(x)
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    share = np.array([got[i].n_links / true[i] for i in range(len(x)) if true[i]])
    assert (share <= 1).all() and share.mean() >= neargraph.MIN_RECALL - 0.01
    assert abs(share.mean() - got[0].audit_recall) < 0.02


def test_what_the_graph_cannot_find_the_blocks_do(spark, monkeypatch):
    """An index that finds next to nothing ends in a comparison of all blocks, which loses nothing."""
    monkeypatch.setattr(neargraph, "SHARD_ROWS", 60)
    monkeypatch.setattr(neargraph, "_found", lambda nodes, *_: nodes.sparkSession.createDataFrame([], "node bigint, links bigint, root bigint"))
    x = vectors(5, 200, 90)
    got = {r.vec_id: (r.n_links, r.component_id) for r in neargraph.near_duplicates(frame(spark, x)).collect()}
    assert got == brute(x, range(len(x)))


def test_every_length_is_searched(spark, monkeypatch):
    """Half of the vectors have one length, half another, some lengths have two; none is left out for being rarer."""
    monkeypatch.setattr(neargraph, "SHARD_ROWS", 100)
    x = [list(v) for v in vectors(1, 150, 40, 16)] + [list(v) for v in vectors(2, 150, 40, 20)] + [[1.0] * 5, [1.0] * 5, [2.0] * 6, [1.0] * 6, [3.0]]
    got = {r.vec_id: (r.n_links, r.component_id) for r in neargraph.near_duplicates(frame(spark, x)).collect()}
    want = {}
    for size in (16, 20, 5, 6, 1):
        ids = [i for i, v in enumerate(x) if len(v) == size]
        want |= brute(np.array([x[i] for i in ids]), ids)
    assert got.keys() == want.keys() and sum(got[i] == want[i] for i in got) >= 0.98 * len(got)
    assert all(got[i] == want[i] for i in range(len(x) - 5, len(x)))


def test_blocks_compare_every_pair_once(spark):
    x = vectors(8, 120, 60)
    df = spark.createDataFrame([(i, v.tolist(), 1 + i % 3, len(v)) for i, v in enumerate(x)], "node bigint, vector array<double>, weight bigint, size int")
    unit = neargraph.unit(x)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    weight = np.array([1 + i % 3 for i in range(len(x))])
    for blocks in (1, 4):
        found = neargraph._all_blocks(df, blocks, 0.9).groupBy("node").sum("links").collect()
        links = {r[0]: r[1] for r in found}
        assert [links.get(i, 0) for i in range(len(x))] == (close @ weight).tolist()
