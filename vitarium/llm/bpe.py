"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over ``WINDOW`` bytes cuts texts into chunks wherever it ends in zeros, so that
texts which share a passage share its chunks whatever stands before it.  Documents are
rebalanced by their least chunk hash, which brings near and exact copies into one partition
(adaptive execution splits a hot one); there each distinct chunk is encoded once.

A cut may fall inside a word.  An anchor is a space between two printing characters: no token
of the supported vocabularies reaches over one.  The ids kept of a chunk are those between its
first and last anchor; at each join the text from the last anchor of the left to the first of
the right is encoded anew, and where a chunk has no anchor the join widens over the next, so
the ids agree with those of the whole text.

Null texts are empty; texts of any length are encoded whole; repeated rows stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from vitarium.llm.arrow import flat_texts, map_texts
from vitarium.llm.tokens import BpeEncoder, encoder, worker_cache

WINDOW = 16
#: A chunk ends where this many low bits of the hash are zero: 1 KB on average.
CUT_BITS = 10
#: Bytes of chunks kept per worker; beyond it they are forgotten and encoded anew if met again.
MEMO_BYTES = 8 << 20
#: Tokens decoded at a time.
DECODED_AT_ONCE = 1 << 19
#: Bytes hashed at a time.
PIECE = 1 << 22

_GEAR = np.random.default_rng(16).integers(0, 2**32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place (fewer at the beginning)."""
    found = _GEAR[data]
    step = 1
    while step < WINDOW:
        found[step:] += found[:-step] << np.uint32(step)
        step *= 2
    return found


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of chunks within a text (not its own end) and the hash at each."""
    ends, hashes = [], []
    mask = np.uint32((1 << CUT_BITS) - 1)
    for at in range(0, len(data), PIECE):
        lead = min(at, WINDOW - 1)
        found = rolling_hash(data[at - lead:at + PIECE])
        # the low bits of a sum of shifted values depend on the last few bytes alone; take the high ones
        hit = np.flatnonzero((found >> np.uint32(32 - CUT_BITS) & mask) == 0)
        hit = hit[hit + at - lead >= max(at, WINDOW - 1)]
        hashes.append(found[hit])
        ends.append(hit + at - lead + 1)
    ends, hashes = np.concatenate(ends or [np.zeros(0, int)]), np.concatenate(hashes or [np.zeros(0, np.uint32)])
    inside = ends < len(data)
    return ends[inside], hashes[inside]


def _starts_character(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (data[places] & 0xC0) != 0x80


def chunks(data: np.ndarray) -> list[bytes]:
    """A text's chunks, cut before a character's first byte only."""
    ends, _ = cuts(data)
    ends = ends[_starts_character(data, ends)].tolist()
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends], [*ends, len(raw)])]


def _least_hash(texts: pa.Array) -> pa.Array:
    """Of each text's chunks the least hash: copies agree, near copies nearly always."""
    data, starts = flat_texts(texts)
    out = np.zeros(len(starts) - 1, np.int64)
    for row, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        _, hashes = cuts(data[a:b])
        # the bits that decide a cut are alike in all: mix, so that the least is any of them
        mixed = hashes * np.uint32(0x85EBCA6B) ^ hashes >> np.uint32(7)
        out[row] = int(mixed.min()) if len(mixed) else int.from_bytes(data[a:b][:8].tobytes(), "little", signed=False) >> 1
    return pa.array(out)


def _parts(chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
    """A chunk up to its first anchor, between first and last, and from the last on."""
    first = _anchor(chunk, 1, 1)
    if first < 0:
        return None
    last = _anchor(chunk, len(chunk) - 2, -1)
    return chunk[:first], chunk[first:last], chunk[last:]


def _anchor(chunk: bytes, at: int, step: int) -> int:
    while True:
        at = chunk.find(b" ", at, -1) if step > 0 else chunk.rfind(b" ", 1, at + 1)
        if at < 0 or (chunk[at - 1] > 32 and chunk[at + 1] > 32):
            return at
        at += step


def encode_texts(texts: pa.Array, codec: BpeEncoder, memo: dict[bytes, tuple]) -> list[bytes]:
    """The ids of each text, with chunks looked up in and added to ``memo``."""
    data, starts = flat_texts(texts)
    cut = [chunks(data[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    new = list({c for parts in cut for c in parts}.difference(memo))
    if sum(map(len, memo)) + sum(map(len, new)) > MEMO_BYTES:
        memo.clear()
        new = list({c for parts in cut for c in parts})
    split = [_parts(c) for c in new]
    inner = codec.encode([p[1].decode() if p else "" for p in split])
    memo.update((c, p and (p[0], ids, p[2])) for c, p, ids in zip(new, split, inner))

    joins: list[bytes] = []
    plans: list[list[bytes | int]] = []  # ids, or the number of a join
    for parts in cut:
        plan, open_ = [], b""
        for chunk in parts:
            known = memo[chunk]
            if known is None:
                open_ += chunk
                continue
            head, ids, tail = known
            plan += [len(joins), ids]
            joins.append(open_ + head)
            open_ = tail
        plan.append(len(joins))
        joins.append(open_)
        plans.append(plan)
    mended = codec.encode([j.decode() for j in joins])
    return [b"".join(mended[x] if isinstance(x, int) else x for x in plan) for plan in plans]


def encode(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``ids``."""
    near = arrow_udf(_least_hash, "bigint")
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    dealt = source.withColumn("near", near("text")).hint("rebalance", "near")

    def step(texts: pa.Array) -> list:
        codec = encoder(tokenizer)
        found = encode_texts(texts, codec, worker_cache().setdefault(("chunks", tokenizer), {}))
        sizes = np.array([len(x) // codec.dtype.itemsize for x in found])
        values = np.frombuffer(b"".join(found), codec.dtype).astype(np.int32)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

    return map_texts(dealt, ["id"], "text", [("ids", "array<int>")], step).toDF(id_column, "ids")


def _names(tokenizer: str):
    """The tokens by id if the vocabulary has no decoder, which means they are joined by spaces; else the library."""
    from tokenizers import Tokenizer

    cache = worker_cache()
    if ("tokens", tokenizer) not in cache:
        library = Tokenizer.from_file(tokenizer)
        tokens = library.get_vocab(with_added_tokens=True)
        names = np.full(max(tokens.values()) + 1, "", object)
        names[list(tokens.values())] = list(tokens)
        cache["tokens", tokenizer] = names if library.decoder is None else library
    return cache["tokens", tokenizer]


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text its ids stand for, special tokens included; null ids are no ids."""
    source = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)))
    column = df.columns.index(ids)
    schema = T.StructType([*source.schema.fields, T.StructField("text", T.StringType())])

    def texts(part: pa.Array) -> list[str]:
        names = _names(tokenizer)
        if not isinstance(names, np.ndarray):
            return names.decode_batch([x or [] for x in part.to_pylist()], skip_special_tokens=False)
        return [" ".join(names[x.values.to_numpy(zero_copy_only=False)]) if x.is_valid else "" for x in part]

    def run(batches):
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + DECODED_AT_ONCE, "right")))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts(part.column(column)), pa.string())],
                                                 names=schema.names)
                at = to

    return source.mapInArrow(run, schema).toDF(*df.columns, name)
