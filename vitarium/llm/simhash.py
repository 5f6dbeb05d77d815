"""Near-duplicates by SimHash and a hierarchical index in Gray order.

Fingerprints are made of whole texts.  Distinct ones are sorted by the rank of their
bits read as a Gray code and cut into tiles; neighbours in that order share many bits.
A node of the index is a mask of the bits that all codes below it share, and their
values: tiles have nodes of 16 and of 256 codes inside, range partitions and groups of
64 nodes stand above.  Two nodes whose shared bits differ in more than the allowed number
hold no linked codes, so whole groups of pairs are pruned on the way down; what is left is
compared code by code.  Nothing is dropped: the pruning bound is exact.

Null and empty texts have fingerprint zero, which links like any other.  Texts of fewer
words than a shingle are one shingle.  Rows of one id are kept apart; a null id is the
representative of nothing, and its component is null if no other id is in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium.llm.arrow import flat_texts, map_texts
from vitarium.llm.components import components
from vitarium.session import stored

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Codes per tile; a tile pair is compared in one go.
TILE = 8192
#: Codes per node inside a tile, from the top.
LEVELS = (256, 16)
#: Nodes that get one node above them, and the most that stand on top.
FAN = 64
#: Shingles whose bits are counted at a time.
BITS_AT_ONCE = 1 << 16
#: Node pairs compared at a time.
PAIRS_AT_ONCE = 1 << 14


# --- fingerprints --------------------------------------------------------------
def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_digest
    data, starts = flat_texts(texts)
    out = np.zeros(len(starts) - 1, np.uint64)
    for row, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        words = data[a:b].tobytes().lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            digests = digest(joined, SEED)
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
            digests = b"".join([digest(joined[s:e], SEED) for s, e in zip(begins.tolist(), ends[shingle - 1:].tolist())])
        hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
        ones = sum(np.unpackbits(hashes[i:i + BITS_AT_ONCE], axis=1).sum(axis=0, dtype=np.int64)
                   for i in range(0, len(hashes), BITS_AT_ONCE))
        out[row] = np.packbits(2 * ones > len(hashes)).view(">u8")[0]
    return out


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE,
                 name: str = "fingerprint") -> DataFrame:
    """Columns ``keep`` and the 64-bit fingerprint, as a signed number."""
    return map_texts(df, keep, text, [(name, "bigint")], lambda texts: [fingerprints_of(texts, shingle).view(np.int64)])


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


# --- the index -----------------------------------------------------------------
def gray_rank(code: Column) -> Column:
    """Where a code stands in Gray order, as a signed number that sorts like the unsigned rank."""
    rank = code
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def patterns(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per run of ``size`` codes: mask of the bits they share, and those bits."""
    starts = np.arange(0, len(codes), size)
    every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    mask = ~(every ^ some)
    return mask, every & mask


def _expand(pairs: np.ndarray, ratio: int, left: int, right: int) -> np.ndarray:
    """Pairs of nodes to pairs of their children, of which there are ``left`` and ``right``."""
    steps = np.arange(ratio)
    a = (pairs[:, 0, None] * ratio + steps)[:, :, None]
    b = (pairs[:, 1, None] * ratio + steps)[:, None, :]
    a, b = np.broadcast_arrays(a, b)
    a, b = a.ravel(), b.ravel()
    real = (a < left) & (b < right)
    return np.stack([a[real], b[real]], axis=1)


def close_pairs(left: np.ndarray, right: np.ndarray, distance: int):
    """Blocks of index pairs of codes that differ in at most ``distance`` bits."""
    sizes = [*LEVELS, 1]
    nodes = [(patterns(left, s), patterns(right, s)) for s in sizes]

    def descend(pairs: np.ndarray, level: int):
        for i in range(0, len(pairs), PAIRS_AT_ONCE):
            block = pairs[i:i + PAIRS_AT_ONCE]
            (mask_a, bits_a), (mask_b, bits_b) = nodes[level]
            a, b = block[:, 0], block[:, 1]
            apart = np.bitwise_count((bits_a[a] ^ bits_b[b]) & mask_a[a] & mask_b[b])
            block = block[apart <= distance]
            if not len(block):
                continue
            if level == len(sizes) - 1:
                yield block
                continue
            (below_a, _), (below_b, _) = nodes[level + 1]
            ratio = sizes[level] // sizes[level + 1]
            for j in range(0, len(block), max(1, PAIRS_AT_ONCE * 16 // ratio ** 2)):
                part = block[j:j + max(1, PAIRS_AT_ONCE * 16 // ratio ** 2)]
                yield from descend(_expand(part, ratio, len(below_a), len(below_b)), level + 1)

    (top_a, _), (top_b, _) = nodes[0]
    yield from descend(_expand(np.zeros((1, 2), np.int64), max(len(top_a), len(top_b)), len(top_a), len(top_b)), 0)


class Forest:
    """Union of links into trees, whole arrays at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(self.root[self.root], self.root):
                self.root = self.root[self.root]


def tile_links(left: np.ndarray, right: np.ndarray, distance: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the close pairs of two tiles connect, one per code at most."""
    codes = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    forest = Forest(len(codes))
    for block in close_pairs(left, right, distance):
        forest.join(block[:, 0], block[:, 1] + shift)
    child = np.flatnonzero(forest.root != np.arange(len(codes)))
    return codes[child], codes[forest.root[child]]


def _tiles(codes: DataFrame, parts: int) -> DataFrame:
    """Tiles of codes in Gray order: part, number within it, shared bits, the codes."""
    ranged = codes.withColumn("rank", gray_rank(F.col("fp"))).repartitionByRange(parts, "rank").sortWithinPartitions("rank")

    def run(batches):
        part, number, kept = None, 0, np.zeros(0, np.uint64)

        def row(tile):
            nonlocal number
            mask, bits = patterns(tile, len(tile))
            number += 1
            return pa.RecordBatch.from_pydict({
                "part": [part], "tile": [number - 1], "mask": mask.view(np.int64), "bits": bits.view(np.int64),
                "codes": [tile.tobytes()]}, schema=SCHEMA)

        for batch in batches:
            if batch.num_rows:
                part = batch.column(0)[0].as_py()
                kept = np.concatenate([kept, batch.column(1).to_numpy().view(np.uint64)])
                while len(kept) >= TILE:
                    yield row(kept[:TILE])
                    kept = kept[TILE:]
        if len(kept):
            yield row(kept)

    SCHEMA = pa.schema([("part", pa.int32()), ("tile", pa.int32()), ("mask", pa.int64()), ("bits", pa.int64()),
                        ("codes", pa.binary())])
    return ranged.select(F.spark_partition_id().alias("part"), "fp").mapInArrow(
        run, "part int, tile int, mask bigint, bits bigint, codes binary")


def _above(nodes: DataFrame) -> DataFrame:
    """The nodes over ``(parent, mask, bits)``: what all children share."""
    same = F.bitwise_not(F.bit_or("bits").bitwiseXOR(F.bit_and("bits")))
    mask = F.bit_and("mask").bitwiseAND(same)
    return nodes.groupBy("parent").agg(mask.alias("mask"), F.bit_and("bits").bitwiseAND(mask).alias("bits")).select(
        F.col("parent").alias("node"), "mask", "bits")


def _apart(distance: int) -> Column:
    both = F.col("a_bits").bitwiseXOR(F.col("b_bits")).bitwiseAND(F.col("a_mask")).bitwiseAND(F.col("b_mask"))
    return F.bit_count(both) <= distance


def _side(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.select(*(F.col(c).alias(f"{side}_{c}") for c in nodes.columns))


def _pairs(tiles: DataFrame, parts: int, distance: int) -> DataFrame:
    """Pairs of tiles that may hold linked codes, from the top of the index down."""
    node = F.col("part").cast("long") * (1 << 31) + F.col("tile")
    level = tiles.select(node.alias("node"), F.col("part").cast("long").alias("parent"), "mask", "bits")
    levels, width = [level], parts
    while True:
        above = _above(levels[-1]).withColumn("parent", F.floor(F.col("node") / FAN).cast("long"))
        levels.append(stored(above, "nodes"))
        if width <= FAN:
            break
        width = -(-width // FAN)
    top = levels.pop()
    others = top.select(F.col("node").alias("a_node"), F.col("mask").alias("a_mask"), F.col("bits").alias("a_bits"),
                        F.explode(F.sequence(F.col("node"), F.lit(width - 1).cast("long"))).alias("b_node"))
    pairs = others.join(_side(top.drop("parent"), "b"), "b_node").filter(_apart(distance)).select("a_node", "b_node")
    for level in reversed(levels):
        down = pairs.select(F.col("a_node").alias("a_parent"), F.col("b_node").alias("b_parent"))
        down = down.join(_side(level, "a"), "a_parent").join(_side(level, "b"), "b_parent")
        pairs = down.filter((F.col("a_parent") < F.col("b_parent")) | (F.col("a_node") <= F.col("b_node"))).filter(
            _apart(distance)).select("a_node", "b_node")
    return pairs


def links(codes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links ``(a, b)`` of the distinct codes ``fp``, enough to connect all that are close."""
    n = codes.count()
    parts = max(1, -(-n // TILE))
    tiles = stored(_tiles(codes, parts), "tiles")
    parts = max(parts, (tiles.agg(F.max("part")).first()[0] or 0) + 1)
    node = (F.col("part").cast("long") * (1 << 31) + F.col("tile")).alias("node")
    whole = tiles.select(node, "codes")
    # dealt out by number: a pair of tiles is much work in few bytes
    most = parts * (parts + 1) // 2
    cores = codes.sparkSession.sparkContext.defaultParallelism
    pairs = _pairs(tiles, parts, distance).repartition(max(1, min(most, max(4 * cores, most // 256))), "a_node", "b_node")
    pairs = pairs.join(_side(whole, "a"), "a_node").join(_side(whole, "b"), "b_node")

    def run(batches):
        for batch in batches:
            same = batch.column(0).to_numpy() == batch.column(1).to_numpy()
            for i in range(batch.num_rows):
                left, right = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                a, b = tile_links(left, right, distance, bool(same[i]))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return pairs.select("a_node", "b_node", "a_codes", "b_codes").mapInArrow(run, "a bigint, b bigint")


def groups(prints: DataFrame, id_column: str, distance: int = MAX_DISTANCE) -> DataFrame:
    """``prints`` (with a column ``fingerprint``), ``component`` (one of its codes) and
    ``component_id``, the least id reachable."""
    codes = stored(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(f"`{id_column}`").alias("least")), "codes")
    joined = components(links(codes.select("fp"), distance), "a", "b")
    named = codes.join(joined, codes["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = stored(named.join(least, "component").select(F.col("fp").alias("fingerprint"), "component", "component_id"), "of")
    return prints.join(of, "fingerprint")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = MAX_DISTANCE) -> DataFrame:
    """Per row: the id, its fingerprint in hex digits and the least id of its component."""
    prints = stored(fingerprints(df, [id_column], text, shingle), "prints")
    found = groups(prints, id_column, distance)
    return found.select(f"`{id_column}`", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def representatives(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component with all its columns: of its least id, and of several such rows
    the first by content.  Rows are numbered where they are stored, so equal rows stay apart."""
    row = _free("row", df.columns)
    prints = fingerprints(df, df.columns, text, shingle, _free("fingerprint", df.columns))
    prints = stored(prints.withColumn(row, F.monotonically_increasing_id()), "prints")
    slim = prints.select(F.col(row).alias("row"), F.col(f"`{id_column}`").alias("id"),
                         F.col(prints.columns[-2]).alias("fingerprint"), F.xxhash64(f"`{text}`").alias("content"))
    first = groups(slim, "id", distance).groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "content", "row")).alias("first"))
    return prints.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*(f"`{c}`" for c in df.columns))


def _free(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name
