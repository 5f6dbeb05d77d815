"""Packing along a space-filling curve.

Each document's ids are hashed into a count vector, projected to three dimensions and given
the Hilbert key of its cell, so that similar documents lie near one another on one line.
Documents are range-sorted by key (ties by id and content), token counts are summed up along
the line, and the line is cut every ``LENGTH`` tokens: all sequences but the last are full,
and neighbours share sequences.  Ids are made once and stored; the sort moves only keys and
counts, and each document's ids then meet its place on the line.

A null or empty text is its end token alone.  Repeated rows are packed each.  A document of
any length is cut over as many sequences as it needs.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitarium.llm.arrow import map_texts
from vitarium.llm.tokens import encoder
from vitarium.session import stored

LENGTH = 2048
END_ID = 1
#: Buckets of the hashed count vector, dimensions it is projected to, bits of the key per dimension.
BUCKETS, DIMENSIONS, BITS = 256, 3, 10
#: Projected values this far out (in standard deviations of a random unit vector) share the outer cells.
SPREAD = 4.0


def _axes() -> np.ndarray:
    return np.random.default_rng(4).normal(size=(BUCKETS, DIMENSIONS))


def cells(vectors: np.ndarray) -> np.ndarray:
    """Grid cells of count vectors: square roots, unit length, random projection."""
    vectors = np.sqrt(vectors)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    at = vectors / np.where(norm == 0, 1, norm) @ _axes()
    top = (1 << BITS) - 1
    return np.clip((at / SPREAD + 1) / 2 * top, 0, top).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of grid cells on the Hilbert curve, most significant bits first (Skilling's transform)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def _tokenized(df: DataFrame, id_column: str, text: str, tokenizer: str, end_id: int) -> DataFrame:
    """Per row: id, ids (little-endian), their number, Hilbert key and a checksum for ties."""
    def step(texts: pa.Array) -> list:
        codec = encoder(tokenizer)
        end = np.array([end_id], codec.dtype).tobytes()
        ids = [x + end for x in codec.encode([t or "" for t in texts.to_pylist()])]
        vectors = np.zeros((len(ids), BUCKETS))
        for row, raw in enumerate(ids):
            hashed = np.frombuffer(raw, codec.dtype)[:-1].astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)
            vectors[row] = np.bincount(hashed, minlength=BUCKETS)
        return [ids, [len(x) // codec.dtype.itemsize for x in ids], hilbert_keys(cells(vectors), BITS),
                [zlib.crc32(x) for x in ids]]

    fields = [("ids", "binary"), ("doc_tokens", "bigint"), ("hilbert", "bigint"), ("tie", "bigint")]
    return map_texts(df, [id_column], text, fields, step)


def _placed(slim: DataFrame) -> DataFrame:
    """``(row, at)``: the tokens before each row on the curve."""
    order = ["hilbert", "id", "tie", "row"]
    ranged = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part int, row bigint, n bigint, before bigint"

    def run(batches):
        before = 0
        for batch in batches:
            n = batch.column(2).to_numpy()
            ends = before + np.cumsum(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(ends - n)],
                                             ["part", "row", "n", "before"])
            before = int(ends[-1]) if len(ends) else before

    local = stored(ranged.select(F.spark_partition_id().alias("part"), "row", "n").mapInArrow(run, schema), "curve")
    sizes = local.groupBy("part").agg(F.sum("n").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))  # one row a partition
    return local.join(F.broadcast(starts), "part").select("row", (F.col("start") + F.col("before")).alias("at"))


def pack(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", length: int = LENGTH,
         end_id: int = END_ID) -> DataFrame:
    """Pieces: id, start, length, ids (little-endian unsigned 32-bit), ids_crc32, doc_tokens,
    sequence_id, offset."""
    made = stored(_tokenized(df, id_column, text, tokenizer, end_id).toDF("id", "ids", "n", "hilbert", "tie").withColumn(
        "row", F.monotonically_increasing_id()), "ids")
    wide = "<u2" if _small(tokenizer) else "<u4"
    placed = made.select("row", "id", "ids", "n").join(_placed(made.select("hilbert", "id", "tie", "row", "n")), "row")
    fields = ("start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint")
    source = placed.select("id", "ids", "at")
    schema = f"id {source.schema['id'].dataType.simpleString()}, {fields}"

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            size = 0
            for key, raw, at in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, wide)
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(at + start, length)
                    piece = ids[start:start + length - offset].astype("<u4").tobytes()
                    n = len(piece) // 4
                    for column, value in zip(columns, (key, start, n, piece, zlib.crc32(piece), len(ids), sequence, offset)):
                        column.append(value)
                    start += n
                    size += len(piece)
                if size > 16 << 20:
                    yield _batch(columns, batch.schema.field(0).type)
                    columns, size = [[] for _ in range(8)], 0
            if columns[0]:
                yield _batch(columns, batch.schema.field(0).type)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def _batch(columns: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    names = ["id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _small(tokenizer: str) -> bool:
    from vitarium.llm.tokens import id_dtype

    return id_dtype(tokenizer).itemsize == 2
