import random
import zlib

import numpy as np
import pytest

from tests.llm import corpus
from vitarium.llm import langid

STEMS = {"aa": ["tion", "ing", "the", "er", "house"], "bb": ["heit", "ung", "sch", "ein", "keit"],
         "cc": ["eau", "ment", "oué", "aux", "le"]}


def text_of(rng, lang, n=60):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = [(i, text_of(rng, lang), lang) for i, lang in enumerate(rng.choice("abc") * 2 for _ in range(400))]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 ... !!", "cc"), (None, text_of(rng, "aa"), "aa"),
             (903, text_of(rng, "bb"), None), (904, text_of(rng, "cc", 30_000), "cc"), rows[0]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows


def brute_bag(text):
    raw = bytearray()
    for c in text:
        low = c.lower() if c.isascii() or "À" <= c <= "Þ" else c
        raw += (low if low.isalpha() or ord(low) > 127 else " ").encode()
    counts = np.zeros(langid.BUCKETS, int)
    for n in langid.ORDERS:
        for i in range(len(raw) - n + 1):
            gram = raw[i:i + n]
            if 32 in gram[1:-1] or not gram.strip():
                continue
            code = n
            for byte in gram:
                code = code * 0x01000193 % 2**32 ^ byte
            counts[(code * 0x9E3779B1 % 2**32) >> (32 - langid.BUCKETS.bit_length() + 1)] += 1
    return counts


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_bag_counts_every_gram(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    for text in ["", "a", "ÉÀ été × Übung", "The river, 12 houses; ÄÖÜß!"] + [t for t in corpus.texts()[:8]]:
        assert (langid.bag(np.frombuffer(text.encode(), np.uint8)) == brute_bag(text)).all(), text


def test_held_out_accuracy_and_contract(spark, labelled):
    df, rows = labelled
    model = langid.fit(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(held) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {900, 901, 902}
    assert {r.doc_id for r in got if r.rejected} == {900, 901, 902}


UNSEEN = ["zo", "kra", "pli", "wux", "ygg"]


def strange(kind, rng):
    if kind == "script":
        return "жук пёс дом вода лес река " * 5
    if kind == "signs":
        return "日本語の文章は漢字とかなで書かれています。" * 3
    if kind == "letters":
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(60))
    if kind == "shuffled":
        return langid._shuffled(text_of(rng, "bb"))
    return " ".join("".join(rng.choice(UNSEEN) for _ in range(rng.randint(1, 3))) for _ in range(60))


def test_what_is_no_known_language_is_rejected(spark, labelled):
    df, _ = labelled
    rng = random.Random(9)
    kinds = ["script", "signs", "letters", "shuffled", "unseen"]
    odd = spark.createDataFrame([(i, strange(kinds[i % 5], rng)) for i in range(50)], "doc_id bigint, text string")
    model = langid.fit(df)
    got = {r.doc_id: r.rejected for r in langid.predict(odd, model).collect()}
    assert all(got.values()), [kinds[i % 5] for i, r in got.items() if not r]
    assert langid.accepted(odd, model).count() == 0


def test_clean_held_out_rows_stay(spark, labelled):
    df, _ = labelled
    rng = random.Random(11)
    clean = spark.createDataFrame([(5000 + i, text_of(rng, rng.choice("abc") * 2, rng.choice([30, 60, 400]))) for i in range(600)],
                                  "doc_id bigint, text string")
    assert langid.predict(clean, langid.fit(df)).filter("rejected").count() < 6


def test_each_language_is_foreign_to_the_others(spark, labelled):
    """Learned without one language, its rows are rejected."""
    df, _ = labelled
    for lang in ("aa", "bb", "cc"):
        model = langid.fit(df.filter(df.lang != lang))
        assert model.languages == sorted({"aa", "bb", "cc"} - {lang})
        own = langid.predict(df.filter((df.lang == lang) & (df.doc_id < 400)), model)
        assert own.filter("rejected").count() >= 0.95 * own.count()


def test_one_language_too_many_labels_and_labels_without_text(spark, labelled, monkeypatch):
    df, _ = labelled
    one = langid.fit(df.filter("lang = 'aa'"))
    assert one.languages == ["aa"]
    assert langid.predict(df.filter("lang = 'bb' and doc_id < 400"), one).filter("not rejected").count() == 0
    extra = spark.createDataFrame([(7000 + i, "12 34", "digits") for i in range(20)], "doc_id bigint, text string, lang string")
    assert "digits" not in langid.fit(df.unionByName(extra)).languages
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="distinct labels"):
        langid.fit(df)


def test_accepted_keeps_rows_and_columns(spark, labelled):
    df, rows = labelled
    twice = df.withColumn("rejected", df.doc_id)
    out = langid.accepted(twice, langid.fit(df))
    assert out.columns == twice.columns and out.count() == len(rows) - 3


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(2, "words", None)], "doc_id bigint, text string, lang string")
    assert langid.fit(none) is None
    assert [(r.lang_pred, r.score) for r in langid.predict(none, None).collect()] == [("und", 0.0)]
    assert langid.predict(none.limit(0), langid.fit(none.limit(0))).count() == 0
    # without a model nothing tells languages apart: what has letters is kept
    some = spark.createDataFrame([(1, "words", "x"), (2, "12 !", "y"), (3, None, "z"), (4, "", "w")], "doc_id bigint, text string, rejected string")
    assert [tuple(r) for r in langid.accepted(some, None).collect()] == [(1, "words", "x")]
