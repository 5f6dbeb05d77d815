"""Token-id files: documents in order of their ids, coded by ``rans``.

``write_ids`` range-sorts the documents (the texts move once), encodes them where they land
and writes one row per segment: the documents' ids and token counts beside the coded bytes.
Parquet is the container, so any store that Spark reaches will do.  ``read_ids`` decodes
segments side by side and adds each document's place among all ids.

A null or empty text is its end token alone.  Rows of one id follow each other by the
checksum of their texts.  Rows without an id come first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitarium.llm import rans
from vitarium.llm.arrow import slices
from vitarium.llm.tokens import encoder

#: A segment is closed with this many tokens, a block within it with that many; both hold whole documents.
SEGMENT = 4 << 20
BLOCK = 1 << 18


def _segments(batches, codec, end_id: int):
    """(ids of documents, their token counts, coded bytes) of each segment of a partition."""
    keys, counts, blocks, block, waiting, held = [], [], [], [], 0, 0
    end = np.array([end_id], codec.dtype)

    def close_block():
        nonlocal block, waiting
        if block:
            blocks.append(np.concatenate(block))
        block, waiting = [], 0

    for batch in batches:
        for part in slices(batch, 1):
            texts = [t or "" for t in part.column(1).to_pylist()]
            for key, raw in zip(part.column(0).to_pylist(), codec.encode(texts)):
                ids = np.concatenate([np.frombuffer(raw, codec.dtype), end])
                keys.append(key)
                counts.append(len(ids))
                block.append(ids)
                waiting += len(ids)
                held += len(ids)
                if waiting >= BLOCK:
                    close_block()
                if held >= SEGMENT:
                    close_block()
                    yield keys, counts, rans.encode_segment(blocks)
                    keys, counts, blocks, held = [], [], [], 0
    if keys:
        close_block()
        yield keys, counts, rans.encode_segment(blocks)


def write_ids(df: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
              text: str = "text") -> None:
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("id"), F.crc32(F.coalesce("text", F.lit("")))]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        for number, (keys, counts, data) in enumerate(_segments(batches, encoder(tokenizer), end_id)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([keys], pa.list_(key_type)), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([data], pa.binary())], ["segment", "ids", "counts", "data"])

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(source.schema["id"].dataType)
    coded = ranged.mapInArrow(run, f"segment int, ids array<{kind}>, counts array<bigint>, data binary")
    coded.select(F.spark_partition_id().alias("part"), "*").write.parquet(path)


def read_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Per document: id, ``start`` (ids before it in all files), ``n_tokens``, ``ids`` (unsigned 32-bit)."""
    files = spark.read.parquet(path)
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = files.select("part", "segment", size.alias("size"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.groupBy("part").agg(F.sum("size").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(parts), F.lit(0)).alias("before"))
    at = sizes.select("part", "segment", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("at"))
    placed = files.join(at.join(starts, "part").select("part", "segment", (F.col("at") + F.col("before")).alias("start")),
                        ["part", "segment"])
    kind = files.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, counts = batch.column(0)[row].values, np.array(batch.column(1)[row].as_py(), np.int64)
                at, done = batch.column(3)[row].as_py(), 0
                for ids in rans.decode_segment(batch.column(2)[row].as_py()):
                    ends = np.cumsum(counts[done:])
                    n = int(np.searchsorted(ends, len(ids))) + 1
                    here = counts[done:done + n]
                    offsets = np.concatenate(([0], np.cumsum(here))).astype(np.int32) * 4
                    raw = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [keys[done:done + n], pa.array(at + offsets[:-1].astype(np.int64) // 4), pa.array(here), raw],
                        ["id", "start", "n_tokens", "ids"])
                    at, done = at + len(ids), done + n

    return placed.select("ids", "counts", "data", "start").mapInArrow(
        run, f"id {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("id", id_column)
