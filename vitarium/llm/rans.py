"""Static range asymmetric numeral system over token ids, many lanes at a time.

A segment is a run of documents: one frequency table, then blocks of whole documents.  Each
block is coded by itself with ``LANES`` interleaved 64-bit states that share one stream of
32-bit words; every ``CHECKPOINT`` steps the states and the place in the stream are kept, so
parts of a block can be decoded side by side.  A CRC-32 of the ids closes each block.

Segment layout, little-endian: ``MAGIC``, bits of the frequency scale (u1), lanes (u4), steps
between checkpoints (u4), symbols (u4), bytes of the packed table (u4), packed table
(zlib: gaps between sorted ids, then frequencies less one, u4 each), blocks (u4), for each
block tokens (u8), words (u8), checkpoints (u4), crc32 (u4), places (u8 each), states (u8
each), words (u4 each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"VRS1"
LANES = 512
CHECKPOINT = 128
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


class Table:
    """Frequencies of the ids that occur, scaled to a power of two."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray, bits: int):
        self.ids, self.bits = ids, bits
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = (np.cumsum(self.frequencies) - self.frequencies).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        bits = max(12, len(used).bit_length() + 3)
        room = (1 << bits) - len(used)
        scaled = 1 + counts[used] * room // max(1, int(counts.sum()))
        if len(used):
            scaled[scaled.argmax()] += (1 << bits) - int(scaled.sum())
        return cls(used, scaled, bits)

    def pack(self) -> bytes:
        gaps = np.diff(self.ids, prepend=0)
        return zlib.compress(np.concatenate([gaps, self.frequencies.astype(np.int64) - 1]).astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, raw: bytes, bits: int) -> Table:
        gaps, less = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64).reshape(2, -1)
        return cls(np.cumsum(gaps), less + 1, bits)

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Index of each id in the table."""
        lookup = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 1, np.int64)
        lookup[self.ids] = np.arange(len(self.ids))
        return lookup[ids]

    def symbols(self) -> np.ndarray:
        """Table index for each slot of the scale."""
        return np.repeat(np.arange(len(self.ids)), self.frequencies.astype(np.int64))


def encode_block(places: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT):
    """(places in the stream, states, words) of a block given as table indexes."""
    steps = -(-len(places) // lanes)
    bits = np.uint64(table.bits)
    frequency, start = table.frequencies[places], table.starts[places]
    limit = frequency * ((LOW >> bits) << WORD)
    state = np.full(lanes, LOW)
    words, counts, states = [], np.zeros(steps + 1, np.int64), []
    for step in range(steps - 1, -1, -1):
        here = slice(step * lanes, min((step + 1) * lanes, len(places)))
        x, f = state[: here.stop - here.start], frequency[here]
        over = x >= limit[here]
        out = x[over]
        counts[step] = len(out)
        words.append(out.astype(np.uint32))
        x = np.where(over, x >> WORD, x)
        whole = x // f
        state[: len(x)] = (whole << bits) + (x - whole * f) + start[here]
        if step % every == 0:
            states.append(state.copy())
    at = np.concatenate(([0], np.cumsum(counts[:-1])))[:steps:every]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return at, states[::-1], stream


def decode_part(stream: np.ndarray, at: int, state: np.ndarray, table: Table, symbols: np.ndarray,
                first: int, last: int) -> np.ndarray:
    """Table indexes of tokens ``first`` to ``last`` of a block, from the checkpoint at ``first``."""
    out = np.empty(last - first, np.int64)
    lanes, bits = len(state), np.uint64(table.bits)
    mask = np.uint64((1 << table.bits) - 1)
    state = state.copy()
    for begin in range(0, last - first, lanes):
        x = state[: min(lanes, last - first - begin)]
        slot = x & mask
        found = symbols[slot]
        out[begin:begin + len(x)] = found
        x = table.frequencies[found] * (x >> bits) + slot - table.starts[found]
        low = np.flatnonzero(x < LOW)
        x[low] = x[low] << WORD | stream[at:at + len(low)]
        at += len(low)
        state[: len(x)] = x
    return out


def encode_segment(blocks: list[np.ndarray], lanes: int = LANES, every: int = CHECKPOINT) -> bytes:
    """The bytes of a segment; ``blocks`` are arrays of ids."""
    table = Table.of(np.concatenate(blocks) if blocks else np.zeros(0, np.int64))
    packed = table.pack()
    out = [MAGIC, struct.pack("<BIIII", table.bits, lanes, every, len(table.ids), len(packed)), packed,
           struct.pack("<I", len(blocks))]
    for ids in blocks:
        at, states, words = encode_block(table.places(ids), table, lanes, every)
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        out += [struct.pack("<QQII", len(ids), len(words), len(at), crc), at.astype("<u8").tobytes(),
                *(s.astype("<u8").tobytes() for s in states), words.astype("<u4").tobytes()]
    return b"".join(out)


def decode_segment(raw: bytes) -> Iterator[np.ndarray]:
    """The ids of each block, as unsigned 32-bit numbers; raises if a block's checksum is wrong."""
    if raw[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    head = struct.Struct("<BIIII")
    bits, lanes, every, _, size = head.unpack_from(raw, 4)
    at = 4 + head.size
    table = Table.unpack(raw[at:at + size], bits)
    symbols = table.symbols()
    blocks, = struct.unpack_from("<I", raw, at + size)
    at += size + 4

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(raw, kind, n, at)
        at += found.nbytes
        return found

    for _ in range(blocks):
        n, words, points, crc = struct.unpack_from("<QQII", raw, at)
        at += struct.calcsize("<QQII")
        places, states = take("<u8", points), take("<u8", points * lanes).reshape(points, lanes)
        stream = take("<u4", words).astype(np.uint64)
        span = lanes * every
        parts = [decode_part(stream, int(places[k]), states[k], table, symbols, k * span, min(n, (k + 1) * span))
                 for k in range(points)]
        ids = table.ids[np.concatenate(parts)].astype("<u4") if parts else np.zeros(0, "<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("a block of token ids does not match its checksum")
        yield ids
