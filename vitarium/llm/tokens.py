"""Exact BPE encoding of many texts with the vocabulary files of the tokenizers library.

The library encodes about one megabyte a second.  Texts repeat words, so a text is cut
at single spaces, where neither of the two supported pre-tokenizers looks across, and
each distinct word of a group of texts is encoded once; those met again are remembered.
Words of plain letters, digits and punctuation are encoded together, merge by merge, as
arrays; every other word, and every text with spacing or special tokens that reach over a
cut, goes to the library itself.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vitarium.llm.arrow import flat_texts

#: Words kept per worker, those met more than once in a group of texts; beyond it the memory is filled anew.
MEMO_WORDS = 100_000
#: Texts are worked on in groups of about this many characters, longer ones in pieces.
GROUP_CHARS = 1 << 22
#: Pieces are merged side by side with others of about their length; a longer word goes to the library.
WIDTHS = np.array([*range(1, 17), 20, 24, 32, 48, 64, 96, 128, 192, 256])
#: Room for a row beside a rank; the rank of pairs that do not merge, without and with that room.
ROW_BITS = 8
ROWS = 1 << ROW_BITS
NO_MERGE = np.int32(1 << 22)
#: Set beside the rank in a slot which pairs of a later level would have taken.
MORE = np.int32(1 << 24)
NONE = np.int32(NO_MERGE * ROWS)

OTHER, LETTER, DIGIT, MARK, BREAK, LEAD = range(6)


def worker_cache() -> dict:
    """Kept for the life of a Python worker, whichever way this module's code got there."""
    name = "_vitarium_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def _pieces(text: str):
    """(whether it is the first, piece) of a text cut at single spaces."""
    at = 0
    while len(text) - at > GROUP_CHARS:
        to = text.find(" ", at + GROUP_CHARS)
        if to < 0:
            break
        yield at == 0, text[at:to]
        at = to + 1
    yield at == 0, text[at:]


class PairTable:
    """Merge rank and merged id of pairs of ids; looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray):
        self.made = made.astype(np.int32)
        #: by rank; the last is no pair
        self.left, self.right = (np.append(side, -1).astype(np.int32) for side in (left, right))
        self.levels = []
        todo, bits, odd = np.arange(len(left)), 18, 0x9E3779B1
        while len(todo):
            factors = np.uint32(odd), np.uint32(odd * 0x85EBCA6B % 2**32)
            slot = self._slot(self.left[todo], self.right[todo], factors, bits)
            _, first = np.unique(slot, return_index=True)
            ranks = np.full(1 << bits, len(left), np.int32)
            ranks[slot[first]] = todo[first]
            ranks[np.delete(slot, first)] |= MORE
            self.levels.append((factors, bits, ranks))
            todo = np.delete(todo, first)
            bits, odd = max(10, bits - 2), odd * 0xC2B2AE35 % 2**32 | 1

    @staticmethod
    def _slot(left: np.ndarray, right: np.ndarray, factors: tuple[np.uint32, np.uint32], bits: int) -> np.ndarray:
        return (left.astype(np.uint32) * factors[0] + right.astype(np.uint32) * factors[1]) >> np.uint32(32 - bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found, todo = np.full(len(left), NO_MERGE), None
        for factors, bits, ranks in self.levels:
            rank = ranks.take(self._slot(left, right, factors, bits))
            more = rank >= MORE
            rank &= MORE - 1
            same = (self.left.take(rank) == left) & (self.right.take(rank) == right)
            if todo is None:
                found = np.where(same, rank, NO_MERGE)
            else:
                found[todo[same]] = rank[same]
            rest = np.flatnonzero(more & ~same)
            if not len(rest):
                break
            todo = rest if todo is None else todo[rest]
            left, right = left[rest], right[rest]
        return found


class BpeEncoder:
    """``encode(texts)`` gives each text's ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        model, letters = spec["model"], byte_letters()
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        #: word vocabularies drop white space and case; byte vocabularies keep both
        self.spaced = not suffix
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        column = lambda values: np.array(list(values), np.int64)
        self.pairs = PairTable(column(vocab[a] for a, _ in pairs), column(vocab[b] for _, b in pairs),
                               column(vocab[a + b] for a, b in pairs))
        self.first_ids = column(vocab[x] for x in letters).astype(np.int32)
        self.last_ids = column(vocab[x + suffix] for x in letters).astype(np.int32)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.dtype = _dtype(self.tokens)
        self.kind = np.full(256, OTHER, np.int8)
        self.kind[33:127] = MARK
        self.kind[ord("'")] = OTHER  # contractions
        self.kind[48:58] = DIGIT
        self.kind[65:91] = self.kind[97:123] = LETTER
        self.kind[0xC3] = LEAD
        self.kind[10] = BREAK
        if suffix:
            self.kind[[9, 13]] = BREAK
        self.memo, self.memo_ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.memo_words = memo_words

    # --- texts -----------------------------------------------------------------
    def by_library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Whole texts; the same ids as the library's without special tokens added."""
        parts: list[list[bytes] | None] = [None if any(s in t for s in self.specials) else [] for t in texts]
        group: list[tuple[int, bool, str]] = []
        size = 0
        for row, text in enumerate(texts):
            if parts[row] is None:
                continue
            for first, piece in _pieces(text):
                group.append((row, first, piece))
                size += len(piece)
                if size >= GROUP_CHARS:
                    self._encode_group(group, parts)
                    group, size = [], 0
        self._encode_group(group, parts)
        rest = [i for i, ids in enumerate(parts) if ids is None]
        whole = dict(zip(rest, self.by_library([texts[i] for i in rest])))
        return [whole[i] if ids is None else b"".join(ids) for i, ids in enumerate(parts)]

    def _encode_group(self, group, parts) -> None:
        if not group:
            return
        split = pc.split_pattern(pa.array([piece for _, _, piece in group], pa.string()), " ")
        words, bounds = split.values, split.offsets.to_numpy()
        found = self._lookup(words)
        unclear = np.concatenate(([0], np.cumsum(found.is_null().to_numpy(zero_copy_only=False))))
        data, places = flat_texts(found)
        apart = np.array([first and self.spaced for _, first, _ in group])  # no space stands before their first word
        heads = iter(self.by_library(words.take(pa.array(bounds[:-1][apart])).to_pylist()))
        begins, ends = bounds[:-1] + apart, bounds[1:]
        fine = unclear[begins] == unclear[ends]
        for (row, _, _), alone, known, a, b in zip(group, apart, fine, places[begins].tolist(), places[ends].tolist()):
            head = next(heads) if alone else b""
            if parts[row] is None:
                continue
            if known:
                parts[row] += [head, data[a:b].tobytes()]
            else:  # a word whose ids depend on what stands beside it
                parts[row] = None

    def _lookup(self, words: pa.Array) -> pa.Array:
        """Ids of each word, null where they depend on what stands beside it; words met again are added to the memory."""
        coded = words.dictionary_encode()
        wanted = coded.dictionary
        place = pc.index_in(wanted, value_set=self.memo).fill_null(-1).to_numpy().copy()
        new = place < 0
        place[new] = len(self.memo) + np.arange(new.sum())
        known = pa.concat_arrays([self.memo_ids, self._words(wanted.filter(pa.array(new)))])
        found = known.take(pa.array(place))
        often = np.bincount(coded.indices.to_numpy(), minlength=len(wanted)) > 1
        if len(self.memo) + np.count_nonzero(often & new) > self.memo_words:
            self.memo, self.memo_ids = wanted.filter(pa.array(often)), found.filter(pa.array(often))
        else:
            add = pa.array(often & new)
            self.memo = pa.concat_arrays([self.memo, wanted.filter(add)])
            self.memo_ids = pa.concat_arrays([self.memo_ids, found.filter(add)])
        return found.take(coded.indices)

    # --- words -----------------------------------------------------------------
    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of words between single spaces, with the space before them where spaces count."""
        flat, places = flat_texts(words)
        starts, ends = places[:-1], places[1:]
        kind = self._kinds(flat)
        bad = np.concatenate(([0], np.cumsum(kind == OTHER)))
        plain = (bad[ends] == bad[starts]) & (ends > starts) & (ends - starts < WIDTHS[-1])
        if self.spaced:
            breaks = kind == BREAK
            twice = np.concatenate(([0], np.cumsum(breaks & np.roll(breaks, 1))))
            plain[plain] &= ~breaks[starts[plain]]
            plain &= twice[ends] == twice[starts]
        chosen, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        merged = self._merge_words(flat, kind, starts[chosen], ends[chosen])
        texts = words.take(pa.array(others)).to_pylist()
        ids: list[bytes | None] = [None if self.spaced else b""] * len(texts)
        rest = [i for i, t in enumerate(texts) if t and not (self.spaced and t[0].isspace())]
        for i, found in zip(rest, self.by_library([" " * self.spaced + texts[i] for i in rest])):
            ids[i] = found
        place = np.empty(len(words), np.int64)
        place[chosen], place[others] = np.arange(len(chosen)), len(chosen) + np.arange(len(others))
        return pa.concat_arrays([merged, pa.array(ids, pa.binary())]).take(pa.array(place))

    def _kinds(self, flat: np.ndarray) -> np.ndarray:
        kind = self.kind[flat]
        lead = np.flatnonzero(kind == LEAD)
        second = flat[lead + 1]
        fine = (second >= 0x80) & (second != 0x97) & (second != 0xB7)  # accented Latin letters, no signs
        kind[lead] = kind[lead + 1] = np.where(fine, LETTER, OTHER)
        return kind

    def _merge_words(self, flat, kind, starts, ends) -> pa.Array:
        if not len(starts):
            return pa.array([], pa.binary())
        lengths = ends - starts
        extra = int(self.spaced)
        total = int((lengths + extra).sum())
        to = np.cumsum(lengths + extra) - (lengths + extra)
        source = np.arange(total) - np.repeat(to, lengths + extra) + np.repeat(starts - extra, lengths + extra)
        byte, kinds = flat[source], kind[source]
        begins = np.zeros(total, bool)
        begins[to] = True
        if self.spaced:
            byte[to] = 32
            kinds[to] = kinds[to + 1]  # the space belongs to what follows
        else:
            upper = (byte >= 65) & (byte <= 90)
            accented = (byte >= 0x80) & (byte <= 0x9E) & (np.roll(byte, 1) == 0xC3) & (byte != 0x97)
            byte[upper | accented] += 32
        begins[1:] |= kinds[1:] != kinds[:-1]
        if not self.spaced:
            begins |= kinds == DIGIT
        keep = np.ones(total, bool) if self.spaced else kinds != BREAK
        word = np.repeat(np.arange(len(starts)), lengths + extra)[keep]
        byte, begins = byte[keep], begins[keep]
        final = np.append(begins[1:], True)[:len(byte)]
        ids = np.where(final, self.last_ids[byte], self.first_ids[byte])
        ids, at = self._merge(ids, np.flatnonzero(begins))
        counts = np.bincount(word[at], minlength=len(starts))
        offsets = (np.concatenate(([0], np.cumsum(counts))) * self.dtype.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(self.dtype))])

    def _merge(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges the lowest-ranked pair of each piece until none is left; ids and a place in its piece for each."""
        out = np.full(len(ids), -1, np.int32)
        sizes = np.diff(np.append(starts, len(ids)))
        width = np.searchsorted(WIDTHS, sizes)
        for number in np.unique(width):
            chosen = np.flatnonzero(width == number)
            self._merge_columns(ids, starts[chosen], sizes[chosen], WIDTHS[number], out)
        where = np.flatnonzero(out >= 0)
        return out[where], where

    def _merge_columns(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, out: np.ndarray) -> None:
        """``_merge`` of pieces of up to ``width`` ids: a column each, one merge in every column a round.

        ``pairs`` holds rank and row of each pair, so that a column's least says which and where.
        """
        rows = np.arange(width, dtype=np.int32)[:, None]
        ids = ids[np.minimum(starts + rows, len(ids) - 1)]
        pairs = self._ranked(ids[:-1].ravel(), ids[1:].ravel()).reshape(width - 1, len(starts))
        pairs = np.where(rows[1:] < sizes, pairs, NONE) | rows[:-1]
        while True:
            least = pairs.min(axis=0, initial=NONE)
            over = least >= NONE
            if over.any():
                done, left = np.flatnonzero(over), np.flatnonzero(~over)
                inside = rows[:len(ids)] < sizes[done]
                out[(starts[done] + rows[:len(ids)])[inside]] = ids.take(done, 1)[inside]
                if not len(left):
                    return
                ids, pairs = ids.take(left, 1), pairs.take(left, 1)
                starts, sizes, least = starts[left], sizes[left], least[left]
            n, sizes = len(least), sizes - 1
            at, made = least & (ROWS - 1), self.pairs.made.take(least >> ROW_BITS)
            later = rows[:len(ids) - 1] > at
            ids = np.where(later, ids[1:], ids[:-1])
            pairs = np.where(later[1:], pairs[1:] - 1, pairs[:-1])
            place = at.astype(np.int64) * n + np.arange(n)
            ids.reshape(-1)[place] = made
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at + 1 < sizes)
            first = np.concatenate((place[before] - n, place[after]))
            flat = ids.reshape(-1)
            row = np.concatenate((at[before] - 1, at[after]))
            pairs.reshape(-1)[first] = self._ranked(flat[first], flat[first + n]) | row

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs with room for the row."""
        return self.pairs.ranks(left, right) * np.int32(ROWS)


def _dtype(ids) -> np.dtype:
    return np.dtype("<u2" if max(ids) < 1 << 16 else "<u4")


def id_dtype(path: str) -> np.dtype:
    """The type ids of a vocabulary file are stored in."""
    from tokenizers import Tokenizer

    return _dtype(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


def encoder(path: str) -> BpeEncoder:
    """The worker's encoder for a vocabulary file."""
    cache = worker_cache()
    if ("bpe", path) not in cache:
        cache["bpe", path] = BpeEncoder(path)
    return cache["bpe", path]
