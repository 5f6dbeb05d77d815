import random
import re

import pyarrow as pa
import pytest

from tests.llm import corpus
from vitarium.llm import licences as lic

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MIT = next(t for label, t in lic.TEMPLATES if label == "mit" and len(t) > 100)


def plain(text):
    """Words and phrase places by regular expression and comparison."""
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = []
    for label, phrase in lic.PHRASES:
        parts = phrase.split()
        places += [(i, label) for i in range(len(found)) if found[i:i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return (len(found), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def texts(seed=0):
    rng = random.Random(seed)
    parts = [t for _, t in lic.TEMPLATES] + ["cc by", "CC\nBY", "general public license", "all rights", "All Rights Reserved", "the", "license",
                                             "foo", "cc-by", "ccby", "é", "cc éby", "日本 cc by", "general publics license", "rights reserved"]
    made = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(80)]
    made += ["", None, "cc", "by", "cc by", "ccby", "all rights reserved all rights reserved", "É" * 9, "cc", "", "by"]
    return made + corpus.texts(seed)


@pytest.mark.parametrize("seed", [0, 1])
def test_words_and_phrases(spark, seed):
    rows = [(i, t, 5, "x") for i, t in enumerate(texts(seed))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, labels string").repartition(3)
    got = {r.doc_id: r for r in lic.labels(lic.scan(df)).collect()}
    for i, text, *_ in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text), (i, text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_texts_do_not_run_together():
    scanner = lic.Scanner(lic.TEMPLATES, lic.PHRASES)
    counts, spans = scanner.scan(pa.array(["all rights", "reserved", None, "", "cc", "by cc by"]))
    assert counts.tolist() == [2, 1, 0, 0, 1, 3] and [len(s) for s in spans] == [0, 0, 0, 0, 0, 1]


def labels_of(text):
    scanner = lic.Scanner(lic.TEMPLATES, lic.PHRASES)
    return {scanner.labels[k]: (a, b, s) for k, a, b, s in scanner.scan(pa.array([text]))[1][0]}


def test_templates_whole_changed_and_torn():
    head = "river stone " * 30
    assert labels_of(head + MIT + head)["mit"][0] == 60
    changed = MIT.replace("free of charge", "at no cost at all").replace("sublicense", "lend")
    found = labels_of(head + changed + head)["mit"]
    assert found[0] == 60 and lic.MIN_SHARE <= found[2] < 1
    words = MIT.split()
    assert not labels_of(" ".join(words[:20]))  # a third of it
    torn = " ".join(words[:30]) + " x" * (lic.MAX_GAP + 5) + " " + " ".join(words[30:])
    assert not labels_of(torn)
    assert not labels_of(" ".join(words[30:] + words[:30]))  # in the wrong order
    assert not labels_of("The software is furnished without warranty of any kind and you may use and copy it under the law.")


def test_versions_that_share_most_words_are_told_apart():
    for name in ("gpl-3.0", "gpl-2.0"):
        text = max((t for label, t in lic.TEMPLATES if label == name), key=len)
        assert set(labels_of(text)) == {name, "gpl"}
    assert set(labels_of("Licensed under CC BY-NC 4.0.")) == {"cc-by", "cc-by-nc-4.0"}
    assert set(labels_of("Licensed under CC BY 4.0.")) == {"cc-by", "cc-by-4.0"}


def test_matching_statistics_against_every_run():
    rng = random.Random(3)
    templates = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 14))] for _ in range(6)]
    automaton = lic.Automaton(templates)
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for _ in range(40):
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        for i, (state, length) in enumerate(automaton.stream([automaton.vocabulary.get(w, -1) for w in text]), 1):
            assert length == max((n for n in range(i + 1) if n == 0 or tuple(text[i - n:i]) in runs))
            if length:
                want = {(k, e) for k, t in enumerate(templates) for e in range(length, len(t) + 1) if t[e - length:e] == text[i - length:i]}
                assert set(automaton.places(state)) == want


def test_chain_covers_as_much_as_any_choice():
    rng = random.Random(4)
    for _ in range(200):
        size, at, part = 12, 0, []
        for _ in range(rng.randint(1, 6)):
            at += rng.randint(0, 2)
            length = rng.randint(1, 4)
            part.append((at, at + length, sorted(rng.sample(range(size - length + 1), rng.randint(1, 2)))))
            at += length

        def most(i, place):
            if i == len(part):
                return 0
            a, b, places = part[i]
            return max([most(i + 1, place)] + [b - a + most(i + 1, p + b - a) for p in places if p >= place])
        best = most(0, 0)
        got = lic._best_chain(part, size)
        assert (got[0][2] * size == pytest.approx(best)) if best >= lic.MIN_SHARE * size else got == []


def test_long_and_empty(spark):
    text = (MIT + " ") * 400 + "x " * 200_000
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, "", ""), (None, None, None)], "doc_id bigint, text string, label string")
    got = lic.scan(df).collect()
    assert sorted(len(r.spans) for r in got) == [0, 0, 400, 400]
    assert lic.scan(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lic.scan(df, templates=(("none", "..."),))
