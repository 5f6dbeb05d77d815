"""Hard negatives by threshold joins over an inverted index with norm bounds.

Vectors have integer components; a score is an inner product.  Each anchor's positives are its
best other rows of the same label, and for each of them the best rows of another label are
wanted whose score lies in a window set by the positive's.  Both are answered by one join:
"all rows that score at least ``t`` with this anchor".  It starts with high thresholds; anchors
whose windows did not fill are asked again with lower ones, down to the least score that counts.

In a task a block of rows meets a block of anchors.  The rows' dimensions are taken in order of
their energy.  A row is indexed only up to where the norm of its remaining components times an
anchor's norm falls below the threshold: a pair that shares nothing indexed cannot reach it.
Rows sorted by that length make every posting list a leading run.  Partial scores are
accumulated list by list; a pair is dropped once its partial score and the product of both
remaining norms fall short, and what is left is completed from the rows themselves.

Anchors are a stated query set: every block of them meets every block of rows, and a task holds
one of either.  At most the wanted number of rows per anchor and window leaves a task.

A row takes no part if its id, label or vector is null, or if the vector holds a null or if the
squares of its components sum to 2**53 or more (beyond that a double cannot hold every score).
Missing components of shorter vectors count as zero; an empty vector scores 0.  Repeated rows
are rows each; rows of one id are ranked by score alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitarium.session import stored

#: Components of a block of rows and rows of a block of anchors that meet in a task.
BLOCK_CELLS = 1 << 18
ANCHOR_ROWS = 1024
#: Thresholds for positives, as shares of the largest score an anchor could have; below the last is everything.
LEVELS = (0.8, 0.4, 0.2, 0.0)
#: Thresholds for negatives, as the place between a window's lower and upper end.
PLACES = (0.75, 0.5, 0.0)
#: Anchors asked at once, dimensions taken at once, pairs completed at once.
ASKED, STRIP, PAIRS = 128, 8, 1 << 16
LIMIT = float(1 << 53)


# --- in one task ---------------------------------------------------------------
def _rest(x: np.ndarray) -> np.ndarray:
    """Norm of what follows each dimension, one column more than there are dimensions."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))


def join(x: np.ndarray, asked: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place in ``asked``, place in ``x``, score) of all pairs that score ``least`` or more, in portions."""
    if not len(x) or not len(asked):
        return
    energy = np.argsort(-(x * x).sum(axis=0), kind="stable")
    x, asked = np.ascontiguousarray(x[:, energy]), asked[:, energy]
    rest, asked_rest = _rest(x), _rest(asked)
    norms = asked_rest[:, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(norms > 0, least / norms, np.where(least > 0, np.inf, -np.inf))
    order = np.argsort(-need, kind="stable")
    for i in range(0, len(order), ASKED):
        who = order[i:i + ASKED]
        yield from _joined(x, rest, asked[who], asked_rest[who], least[who], who, need[who].min())


def _joined(x, rest, asked, asked_rest, least, who, need):
    dims = x.shape[1]
    # indexed: the leading dimensions up to where the rest can no longer reach the threshold
    length = (rest >= need * (1 - 1e-9)).sum(axis=1) if need > 0 else np.full(len(x), dims)
    length = np.minimum(length, dims)
    if need <= 0:
        rows = np.arange(len(x))
    else:
        rows = np.flatnonzero(length > 0)
    rows = rows[np.argsort(-length[rows], kind="stable")]
    length = length[rows]
    partial = np.zeros((len(asked), len(rows)))
    slack = 1e-9 * (1 + np.abs(least))
    for at in range(0, dims, STRIP):
        to = min(at + STRIP, dims)
        count = int(np.searchsorted(-length, -at, "left"))  # rows indexed beyond ``at``: a leading run
        if not count:
            break
        lists = x[rows[:count], at:to] * (np.arange(at, to) < length[:count, None])
        partial[:, :count] += asked[:, at:to] @ lists.T
        done = np.minimum(length, to)
        bound = partial + asked_rest[:, done] * rest[rows, done]
        alive = (bound >= (least - slack)[:, None]).any(axis=0)
        if alive.sum() < 0.8 * len(alive):
            rows, length, partial = rows[alive], length[alive], np.ascontiguousarray(partial[:, alive])
    bound = partial + asked_rest[:, length] * rest[rows, length]
    a, b = np.nonzero(bound >= (least - slack)[:, None])
    for i in range(0, len(a), PAIRS):
        pa_, pb = a[i:i + PAIRS], b[i:i + PAIRS]
        score = partial[pa_, pb]
        short = np.flatnonzero(length[pb] < dims)
        if len(short):
            tail = np.arange(dims) >= length[pb[short], None]
            score[short] += np.einsum("pd,pd->p", asked[pa_[short]], x[rows[pb[short]]] * tail)
        good = score >= least[pa_]
        yield who[pa_[good]], rows[pb[good]], score[good].astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group by score, then name."""
    order = np.lexsort((name, -score, group))
    first = np.searchsorted(group[order], group[order])
    return order[np.arange(len(order)) - first < k]


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), dims))
    offsets = column.offsets.to_numpy() if len(column) else np.zeros(1, np.int32)
    sizes = np.diff(offsets)
    line = np.repeat(np.arange(len(column)), sizes)
    out[line, np.arange(len(line)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = column.flatten().to_numpy()
    return out


def _labels(*columns) -> list[np.ndarray]:
    """Labels as numbers that agree between the columns."""
    codes = pa.concat_arrays([c.combine_chunks() for c in columns]).dictionary_encode().indices.to_numpy()
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


class _Best:
    """The first ``k`` of each group over portions that come one by one."""

    def __init__(self, k: int):
        self.k, self.parts = k, []

    def add(self, *columns: np.ndarray) -> None:
        """Group, score, id and more; folded as soon as portions pile up."""
        self.parts.append(columns)
        if sum(len(p[0]) for p in self.parts) > 1 << 18:
            self.parts = [self.get()]

    def get(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        joined = tuple(np.concatenate(c) for c in zip(*self.parts))
        keep = best(joined[0], joined[1], joined[2], self.k)
        return tuple(c[keep] for c in joined)


def _same_label(dims: int, k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names, asked = rows["id"].to_numpy(), anchors["row"].to_numpy()
        mine, theirs = _labels(anchors["label"], rows["label"])
        numbers, found = rows["row"].to_numpy(), _Best(k)
        for a, b, score in join(_matrix(rows["vector"], dims), _matrix(anchors["vector"], dims), anchors["least"].to_numpy()):
            keep = (mine[a] == theirs[b]) & (asked[a] != numbers[b])
            found.add(a[keep], score[keep], names[b[keep]])
        a, score, name = found.get()
        return pa.table({"anchor": asked[a], "score": score, "id": name})

    return run


def _other_label(dims: int, k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names, asked = rows["id"].to_numpy(), anchors["row"].to_numpy()
        mine, theirs = _labels(anchors["label"], rows["label"])
        windows = anchors["windows"].combine_chunks()
        count = len(windows.flatten())
        offsets = windows.offsets.to_numpy()
        field = {f: windows.flatten().field(f).to_numpy() for f in ("rank", "low", "high")}
        owner = np.repeat(np.arange(len(asked)), np.diff(offsets))
        width = int(np.diff(offsets).max(initial=0))
        least = np.full(len(asked), np.iinfo(np.int64).max)
        np.minimum.at(least, owner, field["low"])
        table = np.full((len(asked), width), -1)
        table[owner, np.arange(count) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))] = np.arange(count)
        found = _Best(k)
        for a, b, score in join(_matrix(rows["vector"], dims), _matrix(anchors["vector"], dims), least.astype(float)):
            keep = mine[a] != theirs[b]
            a, b, score = a[keep], b[keep], score[keep]
            for j in range(width):
                w = table[a, j]
                fits = (w >= 0) & (score >= field["low"][w]) & (score <= field["high"][w])
                found.add(w[fits], score[fits], names[b[fits]])
        w, score, name = found.get()
        return pa.table({"anchor": asked[owner[w]], "rank": field["rank"][w], "score": score, "id": name})

    return run


# --- over Spark ----------------------------------------------------------------
def quantised(vector: Column, scale: float = 256.0) -> Column:
    """Components times ``scale``, rounded down; NULL if one is null or not finite, or too large."""
    scaled = F.transform(vector.cast("array<double>"), lambda v: v * scale)
    bad = F.exists(scaled, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LIMIT))
    return F.when(~bad, F.transform(scaled, lambda v: F.floor(v).cast("long")))


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, step, schema: str, name: str) -> DataFrame:
    """``step`` on every block of rows with every block of anchors."""
    groups = -(-anchors.count() // ANCHOR_ROWS)
    if not groups:
        return rows.sparkSession.createDataFrame([], schema)
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("int")
    rows, anchors = rows.toDF(*rows.columns), anchors.select(*(F.col(c).alias(c) for c in anchors.columns))
    left = rows.select("*", block.alias("i"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("j"))
    right = anchors.select("*", group.alias("j"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("i"))
    met = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(step, schema)
    return stored(met, name)


def hard_negatives(df: DataFrame, anchor: Column, id_column: str = "vec_id", vector: str = "vector", label: str = "label", *,
                   positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """Per anchor and positive up to ``negatives`` rows of another label, numbered from 1.

    ``vector`` holds whole numbers.  A negative scores ``least`` to ``most`` percent of its positive.
    ``anchor`` says of a row whether it is an anchor; it is looked at before anything else.
    """
    size = F.aggregate(F.col(f"`{vector}`"), F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    rows = df.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.sqrt(size).alias("norm"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.col("norm") < LIMIT ** 0.5))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    n, dims, longest = rows.agg(F.count("*"), F.max(F.size("vector")), F.max("norm")).first()
    blocks = max(1, -(-n * max(1, dims or 0) // BLOCK_CELLS))
    facts = rows.select("row", "id", "label", "vector")
    anchors = rows.filter("anchor").select("row", "id", "label", "vector", "norm")

    best_first = [F.desc("score"), F.asc("id")]
    left, found = anchors, []
    for level in (*LEVELS, None):
        bound = F.lit(float("-inf")) if level is None else F.col("norm") * (level * (longest or 0.0))
        met = _meet(facts, left.withColumn("least", bound).drop("norm", "id"), blocks, _same_label(max(1, dims or 0), positives),
                    "anchor bigint, score bigint, id bigint", "positives")
        rank = F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first))
        taken = met.withColumn("rank", rank).filter(F.col("rank") <= positives)
        if level is not None:  # what is not filled is asked again, lower
            full = taken.filter(F.col("rank") == positives).select("anchor")
            taken = taken.join(full, "anchor", "left_semi")
            left = stored(left.join(full.withColumnRenamed("anchor", "row"), "row", "left_anti").select(*anchors.columns), "open")
        found.append(taken)
        if left.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    whole = F.expr(f"(score * {least} + 99) div 100"), F.expr(f"score * {most} div 100")
    pairs = stored(pairs.select("anchor", "rank", "score", F.col("id").alias("positive_id"), whole[0].alias("low"),
                                whole[1].alias("high")), "pairs")

    open_, found = pairs.filter("score >= 0 and low <= high").select("anchor", "rank", "low", "high"), []
    for place in PLACES:
        lower = F.ceil(F.col("low") + (F.col("high") - F.col("low")) * place) if place else F.col("low")
        windows = open_.groupBy("anchor").agg(F.collect_list(F.struct(
            F.col("rank").cast("long").alias("rank"), lower.cast("long").alias("low"), "high")).alias("windows"))
        asked = anchors.join(windows.withColumnRenamed("anchor", "row"), "row").select("row", "label", "vector", "windows")
        met = _meet(facts, asked, blocks, _other_label(max(1, dims or 0), negatives),
                    "anchor bigint, rank bigint, score bigint, id bigint", "negatives")
        place_of = F.row_number().over(Window.partitionBy("anchor", "rank").orderBy(*best_first))
        taken = met.withColumn("place", place_of).filter(F.col("place") <= negatives)
        if place:
            full = taken.filter(F.col("place") == negatives).select("anchor", "rank")
            taken = taken.join(full, ["anchor", "rank"], "left_semi")
            open_ = stored(open_.join(full, ["anchor", "rank"], "left_anti"), "open")
        found.append(taken)
        if open_.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.select("anchor", "rank", "place", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        pairs.select("anchor", "rank", "positive_id", F.col("score").alias("positive_score")).join(out, ["anchor", "rank"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), "negative_id", "positive_score",
                "negative_score", F.col("rank").cast("int").alias("positive_rank")))
