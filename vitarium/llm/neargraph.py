"""Near-duplicate vectors by a robust-pruned flat graph.

Centres are fitted on a bounded sample; every distinct vector is filed under its ``overlap``
nearest ones, which gives overlapping shards.  In each shard a flat graph is built: the
nearest vectors of the shard and a few random ones, thinned by robust pruning, with the
edges back.  The adjacency lists of all shards a vector lies in are united.  Then each shard
is searched from its medoid for all its vectors: a greedy beam first, and wherever vectors in
range turn up, each of them is expanded in turn until no new one is found, so a beam full of
links ends no search.  Links are verified in double precision.

An audit compares a bounded sample of vectors with all vectors in blocks, and goes on sampling
until enough vectors with links were seen.  Recall is the mean, over those, of the share of their links
that were found, so a dense group cannot hide lost pairs.  If it is too low, overlap and beam are
widened and the search is done again; if that does not help, every block is compared with every
other, which loses nothing.

No pair of vectors leaves a task: links are counted where they are found, in the first shard
that both vectors share, and tasks return a spanning forest.  Pairs within a task are counted in
portions.  Equal vectors are one node with a weight.  A shard over ``SHARD_LIMIT`` is dealt into
blocks, and each block of vectors is looked for in the graph of each block, so no task holds more than two.

Only vectors of one length can link.  Lengths with few vectors are compared within one task each, the
others are searched one by one.  Vectors that are null, empty or zero, or hold nulls or non-finite
numbers, link with nothing and are kept.  Repeated rows count as vectors each.  A row
without an id takes part; a component without any id has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium.llm.components import components
from vitarium.llm.simhash import Forest
from vitarium.session import stored

MIN_COSINE = 0.9
#: Rows that centres are fitted on, about; rows a shard should hold; most rows of a block; most centres.
SAMPLE = 20_000
SHARD_ROWS = 1500
SHARD_LIMIT = 6000
MAX_CENTRES = 4096
ROUNDS = 6
OVERLAP = 3
#: Candidates, random candidates, out-degree and pruning factor of the graph; width of the beam.
CANDIDATES, RANDOM = 64, 8
DEGREE = 24
ALPHA = 1.2
BEAM = 48
#: Lines drawn through each shard and pivots that order them.
CHAINS, PIVOTS = 2, 32
#: Vectors that the audit checks against all, about: more and more until it has seen enough with links.
AUDIT = (256, 2048, 8192)
AUDIT_LINKED = 64
#: Mean share of a vector's links that must be found again; attempts before all blocks are compared.
MIN_RECALL = 0.97
ATTEMPTS = 3
#: Single precision may be off by so much; what is within is verified.
SLACK = 1e-4
AT_ONCE = 1 << 18
#: Pairs that a search may hold at most: vectors asked at once times vectors of the graph.
CELLS = 8 << 20


# --- in one task ---------------------------------------------------------------
def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit length; scaled first, so that no square overflows or vanishes."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / np.where(top == 0, 1, top)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm == 0, 1, norm)


def fit_centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, a few rounds."""
    rng = np.random.default_rng(3)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        empty = np.bincount(near, minlength=len(centres)) == 0
        centres = np.where(empty[:, None], centres, unit(sums))
    return centres


def robust_prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Of each row's candidates at most ``DEGREE``, each not much nearer to one taken before; -1 fills up."""
    out = np.full((len(own), DEGREE), -1, np.int64)
    for i in range(0, len(own), 256):
        rows = slice(i, i + 256)
        among = x[candidates[rows]]
        far = np.sqrt(np.maximum(2 - 2 * np.einsum("rcd,rd->rc", among, x[own[rows]]), 0))
        between = np.sqrt(np.maximum(2 - 2 * among @ among.transpose(0, 2, 1), 0))
        alive = candidates[rows] != own[rows, None]
        line = np.arange(len(among))
        for k in range(DEGREE):
            left = np.where(alive, far, np.inf)
            pick = left.argmin(axis=1)
            good = np.isfinite(left[line, pick])
            if not good.any():
                break
            out[rows][good, k] = candidates[rows][line, pick][good]
            alive &= ~(ALPHA * between[line, pick] <= far) & good[:, None]
            alive[line, pick] = False
    return out


def build_graph(x: np.ndarray) -> np.ndarray:
    """Adjacency of the unit vectors ``x``: pruned out-edges, then edges back in the same number."""
    n = len(x)
    if n == 1:
        return np.full((1, 2 * DEGREE), -1, np.int64)
    x = x.astype(np.float32)
    rng = np.random.default_rng(n)
    take = min(CANDIDATES, n)
    near = np.concatenate([np.argpartition(-(x[i:i + 512] @ x.T), take - 1, axis=1)[:, :take] for i in range(0, n, 512)])
    forward = robust_prune(x, np.arange(n), np.concatenate([near, rng.integers(0, n, (n, RANDOM))], axis=1))
    source, target = np.repeat(np.arange(n), DEGREE), forward.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(rng.permutation(len(target)), kind="stable")
    order = order[np.argsort(target[order], kind="stable")]
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    back = np.full((n, DEGREE), -1, np.int64)
    fits = place < DEGREE
    back[target[fits], place[fits]] = source[fits]
    return np.concatenate([forward, back, *(_chain(x, rng) for _ in range(CHAINS))], axis=1)


def _chain(x: np.ndarray, rng) -> np.ndarray:
    """Both neighbours on a line through all vectors, ordered by pivot and nearness to it.  Pruning may
    leave a vector among many alike without an edge to it; the lines reach every one."""
    near = x @ x[rng.choice(len(x), min(PIVOTS, len(x)), replace=False)].T
    pivot = near.argmax(axis=1)
    line = np.lexsort((near[np.arange(len(x)), pivot], pivot))
    out = np.full((len(x), 2), -1, np.int64)
    out[line[:-1], 0], out[line[1:], 1] = line[1:], line[:-1]
    return out


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int, least: float):
    """Pairs (query, vector) in range: a greedy beam from the medoid, then every vector in range expanded."""
    n, q = len(x), len(queries)
    x32, q32 = x.astype(np.float32), queries.astype(np.float32)
    medoid = int((x32 @ x32.mean(axis=0)).argmax())
    seen, waiting = np.zeros((q, n), bool), np.zeros((q, n), bool)
    hits_q, hits_x = [], []

    def measure(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Similarities of pairs met for the first time; those in range are noted and wait to be expanded."""
        seen[rows, nodes] = True
        near = np.concatenate([np.einsum("pd,pd->p", x32[nodes[i:i + AT_ONCE]], q32[rows[i:i + AT_ONCE]])
                               for i in range(0, len(rows), AT_ONCE)] or [np.zeros(0, np.float32)])
        hit = near >= least - SLACK
        hits_q.append(rows[hit])
        hits_x.append(nodes[hit])
        waiting[rows[hit], nodes[hit]] = True
        return near

    def fresh(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of the nodes, each pair once, not seen before."""
        to = graph[nodes]
        rows = np.repeat(rows, to.shape[1])[to.ravel() >= 0]
        to = to.ravel()[to.ravel() >= 0]
        new = ~seen[rows, to]
        keys = np.unique(rows[new] * n + to[new])
        return keys // n, keys % n

    ids = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -np.inf, np.float32)
    done = np.ones((q, beam), bool)
    line = np.arange(q)
    ids[:, 0], done[:, 0] = medoid, False
    near[:, 0] = measure(line, np.full(q, medoid))
    while True:
        best = np.where(done, -np.inf, near).argmax(axis=1)
        rows = np.flatnonzero(~done[line, best])
        if not len(rows):
            break
        picked = ids[rows, best[rows]]
        done[rows, best[rows]] = True
        waiting[rows, picked] = False
        at, nodes = fresh(rows, picked)
        if not len(at):
            continue
        value = measure(at, nodes)
        # new pairs as a ragged block beside the beams they compete with
        first = np.searchsorted(at, rows)
        width = int(np.bincount(np.searchsorted(rows, at)).max())
        spot = np.arange(len(at)) - first[np.searchsorted(rows, at)]
        more_near = np.full((len(rows), width), -np.inf, np.float32)
        more_ids = np.full((len(rows), width), -1, np.int64)
        more_near[np.searchsorted(rows, at), spot], more_ids[np.searchsorted(rows, at), spot] = value, nodes
        all_near = np.concatenate([near[rows], more_near], axis=1)
        keep = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[rows] = np.take_along_axis(all_near, keep, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], more_ids], axis=1), keep, axis=1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.isneginf(more_near)], axis=1), keep, axis=1)
    while True:
        # with so many in range, comparing with all the graph's vectors costs less than expanding each
        many = np.flatnonzero(waiting.sum(axis=1) * graph.shape[1] > n)
        for i in range(0, len(many), 256):
            part = many[i:i + 256]
            a, b = np.nonzero((q32[part] @ x32.T >= least - SLACK) & ~seen[part])
            hits_q.append(part[a])
            hits_x.append(b)
        seen[many], waiting[many] = True, False
        rows, nodes = np.nonzero(waiting)
        if not len(rows):
            break
        for i in range(0, len(rows), AT_ONCE // DEGREE):
            part = slice(i, i + AT_ONCE // DEGREE)
            waiting[rows[part], nodes[part]] = False
            measure(*fresh(rows[part], nodes[part]))
    rows, nodes = np.concatenate(hits_q), np.concatenate(hits_x)
    exact = np.concatenate([np.einsum("pd,pd->p", queries[rows[i:i + AT_ONCE]], x[nodes[i:i + AT_ONCE]])
                            for i in range(0, len(rows), AT_ONCE)] or [np.zeros(0)])
    return rows[exact >= least], nodes[exact >= least]


# --- over Spark ----------------------------------------------------------------
def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _valid(vector: Column) -> Column:
    """Only finite numbers, not all zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _file(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """Each node with the shards it is filed under, the nearest first."""
    wide = min(overlap, len(centres))

    def run(batches):
        for batch in batches:
            near = unit(_matrix(batch.column(1))) @ centres.T
            shards = np.argsort(-near, axis=1, kind="stable")[:, :wide].astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, shards.size + 1, wide, dtype=np.int32)), pa.array(shards.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], ["node", "vector", "weight", "shards"])

    return nodes.select("node", "vector", "weight").mapInArrow(
        run, "node bigint, vector array<double>, weight bigint, shards array<int>")


def _build(group: pa.Table) -> pa.Table:
    node = group["node"].to_numpy()
    order = np.argsort(node)
    graph = build_graph(unit(_matrix(group["vector"]))[order])
    named = np.where(graph >= 0, node[order][graph], -1)
    return pa.table({"node": node[order], "near": pa.array([row[row >= 0] for row in named], pa.list_(pa.int64()))})


def _searched(beam: int, least: float):
    def run(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        node, weight = group["node"].to_numpy(), group["weight"].to_numpy()
        order = np.argsort(node)
        group, node, weight = group.take(pa.array(order)), node[order], weight[order]
        vectors, shards = unit(_matrix(group["vector"])), _matrix(group["shards"]).astype(np.int64)
        member = np.flatnonzero(group["member"].to_numpy(zero_copy_only=False))
        asks = np.flatnonzero(group["asks"].to_numpy(zero_copy_only=False))
        if not len(member) or not len(asks):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        near = group["near"].take(pa.array(member)).combine_chunks()
        sizes = np.diff(near.offsets.to_numpy())
        target = near.flatten().to_numpy()
        source = np.repeat(np.arange(len(member)), sizes)
        place = np.arange(len(target)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        spot = np.searchsorted(node[member], target)
        inside = node[member][np.minimum(spot, len(member) - 1)] == target
        graph = np.full((len(member), max(1, int(sizes.max(initial=0)))), -1, np.int64)
        graph[source[inside], place[inside]] = spot[inside]
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        step = max(64, CELLS // len(member))
        for i in range(0, len(asks), step):
            part = asks[i:i + step]
            hit_a, hit_b = search(vectors[member], graph, vectors[part], beam, least)
            for j in range(0, len(hit_a), AT_ONCE):
                a, b = part[hit_a[j:j + AT_ONCE]], member[hit_b[j:j + AT_ONCE]]
                a, b = a[a != b], b[a != b]
                forest.join(a, b)
                # a pair counts in the first shard that both are filed under
                common = (shards[a][:, :, None] == shards[b][:, None, :]).any(axis=2)
                first = np.where(common, shards[a], np.iinfo(np.int64).max).min(axis=1)
                counts = first == shard
                np.add.at(links, a[counts], weight[b[counts]])
        return _linked(node, links, forest)

    return run


def _linked(node: np.ndarray, links: np.ndarray, forest: Forest) -> pa.Table:
    out = np.flatnonzero((links > 0) | (forest.root != np.arange(len(node))))
    return pa.table({"node": node[out], "links": links[out], "root": node[forest.root[out]]})


def _compared(least: float):
    """Every vector of one block with every vector of another, or with those after it in its own."""
    def run(group: pa.Table) -> pa.Table:
        node, weight = group["node"].to_numpy(), group["weight"].to_numpy()
        x, block = unit(_matrix(group["vector"])), group["block"].to_numpy()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        rows, columns = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            a, b = np.nonzero(x[part] @ x[columns].T >= least)
            a, b = part[a], columns[b]
            good = a < b if i == j else a >= 0
            a, b = a[good], b[good]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            for k in range(0, len(a), AT_ONCE):
                forest.join(a[k:k + AT_ONCE], b[k:k + AT_ONCE])
        return _linked(node, links, forest)

    return run


def _all_blocks(nodes: DataFrame, blocks: int, least: float) -> DataFrame:
    """All links, by comparing blocks of about ``SHARD_ROWS`` vectors of a length, each with itself and those after it."""
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    met = F.transform(others, lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    rows = nodes.select("node", "vector", "weight", "size", block.alias("block"))
    rows = rows.select("*", F.explode(met).alias("at")).select("node", "vector", "weight", "size", "block", "at.*")
    return stored(rows.groupBy("size", "i", "j").applyInArrow(_compared(least), "node bigint, links bigint, root bigint"), "found")


def _audited(nodes: DataFrame, sample, least: float) -> DataFrame:
    """Links of the sampled nodes, counted against all nodes in blocks."""
    names = np.array([r.node for r in sample], np.int64)
    asked = unit(np.array([r.vector for r in sample], float))

    def run(batches):
        for batch in batches:
            close = asked @ unit(_matrix(batch.column(1))).T >= least
            close &= names[:, None] != batch.column(0).to_numpy()[None]
            links = close @ batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(links.astype(np.int64))], ["node", "links"])

    return nodes.select("node", "vector", "weight").mapInArrow(run, "node bigint, links bigint").groupBy("node").agg(
        F.sum("links").alias("true_links"))


def _found(nodes: DataFrame, centres: np.ndarray, overlap: int, beam: int, least: float) -> DataFrame:
    filed = stored(_file(nodes, centres, overlap), "filed")
    rows = filed.select("node", "vector", "weight", "shards", F.explode("shards").alias("shard"))
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))  # at most MAX_CENTRES rows
    blocks = F.ceil(F.col("n") / SHARD_LIMIT).cast("int")
    rows = rows.join(F.broadcast(sizes.select("shard", blocks.alias("blocks"))), "shard")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    lists = rows.select("shard", "block", "node", "vector").groupBy("shard", "block").applyInArrow(
        _build, "node bigint, near array<bigint>")
    # at most overlap * 2 * (DEGREE + CHAINS) names a node
    united = stored(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    roles = F.concat(
        F.transform(other, lambda x: F.struct(x.alias("i"), F.col("block").alias("j"), F.lit(True).alias("member"),
                                              (x == F.col("block")).alias("asks"))),
        F.transform(F.filter(other, lambda x: x != F.col("block")), lambda x: F.struct(
            F.col("block").alias("i"), x.alias("j"), F.lit(False).alias("member"), F.lit(True).alias("asks"))))
    asked = rows.join(united, "node").withColumn("role", F.explode(roles)).select(
        "shard", "role.*", "node", "vector", "weight", "shards", "near")
    return stored(asked.groupBy("shard", "i", "j").applyInArrow(
        _searched(beam, least), "node bigint, links bigint, root bigint"), "found")


def _recall(nodes: DataFrame, found: DataFrame, truth: DataFrame) -> tuple[float, int]:
    """Mean share of their links that audited vectors with links got, and how many these are."""
    mine = found.groupBy("node").agg(F.sum("links").alias("links"))
    share = F.coalesce("links", F.lit(0)) / F.col("true_links")
    row = truth.filter("true_links > 0").join(mine, "node", "left").agg(F.avg(share), F.count("*")).first()
    return (1.0 if row[0] is None else float(row[0])), row[1]


def _search_length(nodes: DataFrame, n: int, least: float, overlap: int, beam: int) -> tuple[DataFrame, float]:
    """Links among ``n`` vectors of one length, and the recall that the audit measured."""
    def some(size: int) -> DataFrame:
        return nodes.filter(F.pmod(F.xxhash64("h2", F.lit(size)), F.lit(n)) < size)

    sample = [r.vector for r in some(SAMPLE).select("vector").limit(2 * SAMPLE).collect()]
    k = min(MAX_CENTRES, -(-n * overlap // SHARD_ROWS))
    centres = fit_centres(unit(np.array(sample)), k) if k > 1 and sample else None
    truth = None
    for size in AUDIT:
        asked = some(size).select("node", "vector").limit(2 * size).collect()
        truth = stored(_audited(nodes, asked, least), "audit") if asked else None
        if size >= n or (truth is not None and truth.filter("true_links > 0").count() >= AUDIT_LINKED):
            break
    for _ in range(ATTEMPTS):
        if centres is None:
            break
        found = _found(nodes, centres, overlap, beam, least)
        recall = _recall(nodes, found, truth)[0] if truth is not None else 1.0
        if recall >= MIN_RECALL:
            return found, recall
        overlap, beam = overlap + 2, beam * 2
    return _all_blocks(nodes, max(1, -(-n // SHARD_ROWS)), least), 1.0


def near_duplicates(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", least: float = MIN_COSINE,
                    overlap: int = OVERLAP, beam: int = BEAM) -> DataFrame:
    """Per row: id, n_links, component_id, kept, and the recall that the audit measured."""
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    fits = _valid(F.col("vector"))
    keys = [F.when(fits, F.xxhash64(F.lit(k), F.size("vector"), "vector")).alias(f"h{k}") for k in (1, 2)]  # 128 bits
    keyed = stored(source.select("id", F.when(fits, F.col("vector")).alias("vector"), *keys), "vectors")
    nodes = keyed.filter("vector is not null").groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("id").alias("least"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("vector")), "nodes")
    # lengths beyond a shard's rows are few, as each takes that many vectors; all others are one job
    large = nodes.groupBy("size").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_ROWS).collect()
    small = nodes.filter(~F.col("size").isin([r.size for r in large])) if large else nodes
    found, recall = _all_blocks(small, 1, least), 1.0
    for r in sorted(large):
        more, measured = _search_length(nodes.filter(F.col("size") == r.size), r.n, least, overlap, beam)
        found, recall = found.unionByName(more), min(recall, measured)
    joined = components(found.select("node", "root"), "node", "root")
    links = found.groupBy(F.col("node").alias("linked")).agg(F.sum("links").alias("links"))
    named = nodes.select("node", "h1", "h2", "weight", "least").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = named.join(links, named["node"] == links["linked"], "left")
    least_of = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = stored(named.join(least_of, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"), "of")
    out = keyed.select("id", "h1", "h2").join(of, ["h1", "h2"], "left")
    alone = F.col("h1").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
                      F.lit(float(recall)).alias("audit_recall"))
