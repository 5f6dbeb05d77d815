"""Every stage and the whole run against plain versions over a small table with the hard cases."""

import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_langid import brute_bag
from tests.llm.test_packing import check
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_simhash import brute_groups, brute_print
from vitarium.llm import langid, queries, secrets
from vitarium.session import scratch_path

WORDS = {
    "en": "the of and to in is that it for was river stone house mill bridge road morning letter garden winter".split(),
    "de": "der die und den von zu das mit ist nicht Haus Stein Brücke Straße Mühle Garten Winter Brief Morgen Fluss".split(),
    "fr": "le la les de et des en un une que est maison pierre rivière pont route moulin jardin hiver lettre matin".split()}
#: Names that stages use for results of their own are columns of the table here.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, rejected string, fingerprint bigint, "
          "component_id string, row int, spans int, lang_pred string")


def prose(rng, lang, n=90):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}"]) for _ in range(n)) + "."


def documents():
    rng = random.Random(12)
    texts = [(prose(rng, lang), lang) for lang in rng.choices(list(WORDS), k=150)]
    texts += [(t, lang) for t, lang in texts[:12]]  # exact copies
    texts += [(" ".join(t.split()[:-1]) + " end.", lang) for t, lang in texts[12:24]]  # near copies
    texts += [(prose(rng, "en", 40) + f" password = hunter2{i:04d} " + prose(rng, "en", 40), "en") for i in range(5)]
    texts += [(prose(rng, "de") + " key deadbeef" + "0123456789abcdef" * 2, "de"), (prose(rng, "fr") + " AKIA" + "A1B2C3D4E5F6G7H8", None)]
    texts += [(None, "en"), ("", "de"), ("two words", "fr"), ("same line of it\n" * 60, "en"), ("# | * " * 80, None),
              (" ".join("жук пёс дом вода лес река гора".split()[rng.randrange(7)] + "аеи"[rng.randrange(3)] for _ in range(90)) + " the of and to in", None),
              (prose(rng, "en", 9000), "en")]
    rows = [(i * 3, t, lang, "s", len(t) if t is not None else 0, True, "r", 7, "c", 1, 2, "xx") for i, (t, lang) in enumerate(texts)]
    return rows + [rows[5], (None, prose(rng, "en"), "en", None, 1, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def table(spark):
    folder = scratch_path(spark, "pipeline")
    spark.createDataFrame(documents(), SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder


def stage(spark, name, docs):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert out.columns == docs.columns
    return out


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def masked(text):
    cut = [(a, b) for a, k, b in brute_secrets(text)]
    out, at = "", 0
    for a, b in sorted(cut):
        if a >= at:
            out += text[at:a] + secrets.MASK
        at = max(at, b)
    return out + text[at:]


def test_stages_one_after_another(spark, table):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "simhash near-dedup", "secret scans", "packing"]
    docs = spark.read.parquet(f"{table}/documents.parquet")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{table}/documents.parquet/*.parquet')")
    verdicts = con.execute(f"SELECT doc_id, n_words, kept FROM ({queries.ORACLES['op1_quality']})").fetchall()
    good = stage(spark, "quality rules", docs)
    assert sorted((r.doc_id is None, r.doc_id) for r in good.collect()) == sorted((i is None, i) for i, _, kept in verdicts if kept)
    assert 0 < good.count() < docs.count() and good.filter("text is null").count() == 0

    model = langid.fit(good)
    told = stage(spark, "language ID", good)
    keep = []
    for r in good.collect():
        bag = brute_bag(r.text)[None].astype(np.float32)
        scores = model.scores(bag)[0]
        if re.search(r"[^\W\d_]", r.text) and scores.max() >= model.threshold and model.fits(bag)[0, scores.argmax()] >= model.least_fit:
            keep.append(tuple(r))
    assert values(told) == sorted(keep, key=repr)
    foreign = [r.doc_id for r in good.collect() if "жук" in r.text]
    assert foreign and not told.filter(told.doc_id.isin(foreign)).count()
    assert told.count() >= 0.98 * (good.count() - len(foreign))

    one = stage(spark, "simhash near-dedup", told)
    before = [tuple(r) for r in told.collect()]
    group = brute_groups({brute_print(r[1]) for r in before})
    least = {}
    for r in before:
        g = group[brute_print(r[1])]
        least[g] = min(least.get(g, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    assert values(one) == sorted(least.values(), key=repr)
    assert len(least) < len(before)

    clean = stage(spark, "secret scans", one)
    want = [(r[0], masked(r[1]), *r[2:4], len(masked(r[1])), *r[5:]) for r in (tuple(x) for x in one.collect())]
    assert values(clean) == sorted(want, key=repr)
    assert clean.filter("text like '%[SECRET]%'").count() == 7

    packed = dict(corpus_pipeline.STAGES)["packing"](spark, clean, "").collect()
    check(packed, [r.text for r in clean.collect()], 2048)

    # the run is these stages and nothing else
    again = corpus_pipeline.run(spark, table).collect()
    figures = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(([r[c] for c in figures] for r in again), key=repr) == sorted(([r[c] for c in figures] for r in packed), key=repr)
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokens = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect())
    assert sum(r.length for r in again) == tokens


def test_stages_on_odd_tables(spark):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    nulls = spark.createDataFrame([(None,) * 5, (1, None, None, None, None), (2, "", "", "", 0)], columns)
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, nulls.limit(0), "").count() == 0
        out = function(spark, nulls, "")
        assert out.columns == nulls.columns and out.count() == {"quality rules": 0, "language ID": 0, "simhash near-dedup": 1, "secret scans": 3}[name]
    assert corpus_pipeline.STAGES[-1][1](spark, nulls.limit(0), "").count() == 0
    assert sum(r.length for r in corpus_pipeline.STAGES[-1][1](spark, nulls, "").collect()) == 3  # an end id each


def test_without_labels_documents_with_letters_stay(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, prose(rng, "en"), None, "s", 1) for i in range(5)] + [(9, "12 34", None, "s", 1)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in stage(spark, "language ID", docs).collect()) == list(range(5))


def test_run_of_an_empty_table(spark):
    folder = scratch_path(spark, "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
