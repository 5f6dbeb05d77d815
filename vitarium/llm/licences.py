"""Licence scan: a generalised suffix automaton over the words of licence templates.

Words are runs of ASCII letters (lower-cased), digits and all characters beyond ASCII.  One
automaton holds every run of words of every template.  A text is streamed through it, which
gives for each word the longest run ending there that some template holds (its matching
statistics).  Runs of ``MIN_MATCH`` words or more are matches; per template they are chained,
both in text order and in template order, at most ``MAX_GAP`` words apart, so that the chain covers as
many template words as it can.  A chain that covers ``MIN_SHARE`` of its template is a span, unless it
overlaps a span that covers more words (two versions of a licence differ in few).

Phrases are templates of their own; every place where all their words stand in a row is found,
since a phrase ends where the automaton's match is at least as long and ends with it.

Only words that occur in templates can take part, so runs of such words are picked out of the
bytes of many texts at once, and only those runs are streamed; no run that could hold a match
or a phrase is left out.  Texts are read whole.  A null or empty text has no words and no spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitarium.llm.arrow import flat_texts, map_texts
from vitarium.llm.tokens import worker_cache

MIN_MATCH = 4
MAX_GAP = 40
MIN_SHARE = 0.8

#: Phrases and the labels they stand for; fixed values.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

#: Notices and grants of common licences; fixed values.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
            "whom the Software is furnished to do so, subject to the following conditions"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
                   "OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
                "version 2 of the License, or (at your option) any later version."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words(text: str) -> list[bytes]:
    """The words of one short text."""
    raw = _LOWER[np.frombuffer(text.encode(), np.uint8)]
    return np.where(_WORD[raw], raw, 32).astype(np.uint8).tobytes().split()


class Automaton:
    """All runs of words of several templates, as a suffix automaton.

    Every state stands for runs that end at the same places.  ``suffix`` leads to the longest run
    that ends at more places, ``longest`` is the length of a state's longest run.
    """

    def __init__(self, templates: list[list[bytes]]):
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in templates for w in t))}
        self.templates = [[self.vocabulary[w] for w in t] for t in templates]
        self.step: list[dict[int, int]] = [{}]
        self.suffix, self.longest = [-1], [0]
        for template in self.templates:
            last = 0
            for word in template:
                last = self._grow(last, word)
        # where templates end up, word by word; a state's places are its own and those of states above it
        self.own: list[list[tuple[int, int]]] = [[] for _ in self.step]
        for k, template in enumerate(self.templates):
            state = 0
            for at, word in enumerate(template, 1):
                state = self.step[state][word]
                self.own[state].append((k, at))
        self.above: list[list[int]] = [[] for _ in self.step]
        for state, low in enumerate(self.suffix):
            if low >= 0:
                self.above[low].append(state)
        self._places: dict[int, list[tuple[int, int]]] = {}

    def _state(self, length: int, step: dict[int, int], suffix: int) -> int:
        self.longest.append(length)
        self.step.append(step)
        self.suffix.append(suffix)
        return len(self.longest) - 1

    def _split(self, low: int, word: int, high: int) -> int:
        """The state for runs of ``high`` no longer than one word after ``low``."""
        if self.longest[high] == self.longest[low] + 1:
            return high
        part = self._state(self.longest[low] + 1, dict(self.step[high]), self.suffix[high])
        self.suffix[high] = part
        while low >= 0 and self.step[low].get(word) == high:
            self.step[low][word] = part
            low = self.suffix[low]
        return part

    def _grow(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.longest[last] + 1, {}, 0)
        low = last
        while low >= 0 and word not in self.step[low]:
            self.step[low][word] = new
            low = self.suffix[low]
        if low >= 0:
            self.suffix[new] = self._split(low, word, self.step[low][word])
        return new

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, words up to the end) wherever the runs of a state end."""
        if state not in self._places:
            found, waiting = [], [state]
            while waiting:
                s = waiting.pop()
                found += self.own[s]
                waiting += self.above[s]
            self._places[state] = found
        return self._places[state]

    def stream(self, ids: list[int]):
        """Matching statistics: after each word the state and the length of the longest run."""
        state = length = 0
        step, suffix, longest = self.step, self.suffix, self.longest
        for word in ids:
            to = step[state].get(word)
            while to is None and state:
                state = suffix[state]
                length = longest[state]
                to = step[state].get(word)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            yield state, length


class Scanner:
    """Templates and phrases in one automaton, and what picks runs of words out of bytes."""

    def __init__(self, templates, phrases):
        self.labels = [label for label, _ in (*phrases, *templates)]
        parts = [words(text) for _, text in (*phrases, *templates)]
        if not all(parts):
            raise ValueError("a template or phrase without words")
        self.phrases = len(phrases)
        self.automaton = Automaton(parts)
        a = self.automaton
        # phrases by the state they end in, handed on to every state whose runs end with them
        self.ends: dict[int, list[int]] = {}
        for k in range(self.phrases):
            state = 0
            for word in a.templates[k]:
                state = a.step[state][word]
            waiting = [state]
            while waiting:
                s = waiting.pop()
                self.ends.setdefault(s, []).append(k)
                waiting += a.above[s]
        self.heads = np.unique(np.array([_head(w) for w in a.vocabulary], np.uint64))
        codes = [[int(np.searchsorted(self.heads, np.uint64(_head(w)))) for w in part] for part in parts[:self.phrases]]
        self.firsts = [(c[0], c[1] if len(c) > 1 else None) for c in codes]

    # --- runs of template words in many texts ---
    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int, int, float]]]]:
        """Per text its number of words, and spans (template or phrase, first word, word after the last, share)."""
        data, starts = flat_texts(texts)
        base = int(starts[0])
        data, starts = _LOWER[data[base:int(starts[-1])]], starts - base
        inside = np.concatenate([_WORD[data], [False]])
        before = np.concatenate([[False], inside[:-1]])
        before[starts[:-1]] = False  # a text's first byte begins a word, whatever stands before it
        begin = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]])
        after[starts[1:] - 1] = False  # a text's last byte ends one; an empty text only repeats its neighbour's
        finish = np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(begin, starts)
        found: list[list] = [[] for _ in range(len(texts))]
        for a, b, row in self._runs(data, begin, finish, first):
            found[row].append((a - int(first[row]), self._stream(data, begin, finish, a, b)))
        return np.diff(first), [self._spans(runs) if runs else [] for runs in found]

    def _runs(self, data, begin, finish, first):
        """Longest runs of words that may be in templates, if a match or a phrase fits in: (from, to, text)."""
        if not len(begin):
            return
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        size = finish - begin
        head = np.zeros(len(begin), np.uint64)
        for k in range(8):
            head |= np.where(size > k, padded[begin + k], 0).astype(np.uint64) << np.uint64(8 * k)
        code = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
        code = np.where(self.heads[code] == head, code, -1)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        edge = np.flatnonzero((code[1:] < 0) | (code[:-1] < 0) | (owner[1:] != owner[:-1])) + 1
        lows = np.concatenate([[0], edge])
        highs = np.concatenate([edge, [len(code)]])
        keep = (highs - lows >= MIN_MATCH) & (code[lows] >= 0)
        for one, two in self.firsts:
            hit = code == one
            if two is not None:
                hit[:-1] &= code[1:] == two
                hit[-1:] = False
            keep[np.searchsorted(lows, np.flatnonzero(hit), "right") - 1] = True
        for a, b in zip(lows[keep].tolist(), highs[keep].tolist()):
            yield a, b, int(owner[a])

    def _stream(self, data, begin, finish, a: int, b: int) -> list[tuple[int, int]]:
        get = self.automaton.vocabulary.get
        raw, low = data[begin[a]:finish[b - 1]].tobytes(), int(begin[a])
        ids = [get(raw[x - low:y - low], -1) for x, y in zip(begin[a:b].tolist(), finish[a:b].tolist())]
        return list(self.automaton.stream(ids))

    # --- matches of one text ---
    def _spans(self, runs) -> list[tuple[int, int, int, float]]:
        a = self.automaton
        out, pieces = [], {}
        for first, seen in runs:
            for i, (state, length) in enumerate(seen):
                for k in self.ends.get(state, ()):
                    if len(a.templates[k]) <= length:
                        out.append((k, first + i + 1 - len(a.templates[k]), first + i + 1, 1.0))
                if length >= MIN_MATCH and (i + 1 == len(seen) or seen[i + 1][1] != length + 1):
                    self._match(state, length, first + i + 1, pieces)
        spans = [(k, *span) for k, found in pieces.items() for span in chained(found, len(a.templates[k]))]
        return sorted(out + self._fullest(spans), key=lambda s: (s[1], s[2], s[0]))

    def _fullest(self, spans):
        """Spans but those of which a word lies in a span that covers more words."""
        most: dict[int, float] = {}
        covered = [share * len(self.automaton.templates[k]) for k, _, _, share in spans]
        for (_, first, end, _), size in zip(spans, covered):
            for w in range(first, end):
                most[w] = max(most.get(w, 0.0), size)
        return [s for s, size in zip(spans, covered) if all(most[w] <= size for w in range(s[1], s[2]))]

    def _match(self, state: int, length: int, end: int, pieces: dict) -> None:
        """Notes a run that ends at word ``end``, for each template as long as it agrees with that one."""
        a, seen = self.automaton, set()
        while state > 0 and length >= MIN_MATCH:
            here = {}
            for k, at in a.places(state):
                if k >= self.phrases and k not in seen:
                    here.setdefault(k, []).append(at - length)
            for k, froms in here.items():
                pieces.setdefault(k, []).append((end - length, end, froms))
            seen |= here.keys()
            state = a.suffix[state]
            length = min(length, a.longest[state])


def _head(word: bytes) -> int:
    return int.from_bytes(word[:8], "little")


def chained(found: list[tuple[int, int, list[int]]], size: int) -> list[tuple[int, int, float]]:
    """Spans (first word, word after the last, share covered) of one template of ``size`` words.

    ``found`` are matches (from, to, places in the template).  They are cut apart where a gap is too long and
    where one begins at the template's start; within such a part the best chain is one span.
    """
    out, part, last = [], [], 0
    for start, end, places in sorted(found):
        cut = max(0, last - start) if part else 0
        if part and (start - last > MAX_GAP or (not cut and 0 in places)):
            out += _best_chain(part, size)
            part = []
        if end - start > cut:
            part.append((start + cut, end, [p + cut for p in places]))
            last = end
    return out + (_best_chain(part, size) if part else [])


def _best_chain(part, size: int) -> list[tuple[int, int, float]]:
    """The chain of matches, rising in the template, that covers the most of it, if that is enough."""
    tree: list[tuple[int, int]] = [(0, -1)] * (size + 1)  # most covered up to a template place, and from which word
    best = (0, -1, -1)
    for start, end, places in part:
        new = []
        for place in places:
            at, top = place, (0, -1)
            while at > 0:
                top = max(top, tree[at])
                at -= at & -at
            covered = top[0] + end - start
            begin = top[1] if top[0] else start
            new.append((place + end - start, (covered, begin)))
            best = max(best, (covered, begin, end))
        for at, value in new:
            while at <= size:
                tree[at] = max(tree[at], value)
                at += at & -at
    return [(best[1], best[2], best[0] / size)] if best[0] >= MIN_SHARE * size else []


# --- over Spark ----------------------------------------------------------------
SPANS = "array<struct<label:string,phrase:boolean,first:bigint,last:bigint,share:double>>"


def scan(df: DataFrame, id_column: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Per row: the id, ``n_words`` and ``spans`` (label, phrase or template, first and last word, share covered)."""
    key = ("licences", tuple(templates), tuple(phrases))
    Scanner(templates, phrases)  # a faulty template is an error here, not in a task

    def step(texts: pa.Array) -> list:
        cache = worker_cache()
        if key not in cache:
            cache[key] = Scanner(templates, phrases)
        scanner = cache[key]
        counts, spans = scanner.scan(texts)
        return [counts, [[{"label": scanner.labels[k], "phrase": k < scanner.phrases, "first": a, "last": b - 1, "share": share}
                          for k, a, b, share in found] for found in spans]]

    return map_texts(df, [id_column], text, [("n_words", "bigint"), ("spans", SPANS)], step)


def labels(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row of :func:`scan`: base counts and places, labels of phrases, all labels, and the best share."""
    base = F.filter("spans", lambda s: s["phrase"])

    def named(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        F.col(f"`{id_column}`"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        named(base).alias("base_labels"), named(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))
