"""Every registered query, digests included, over one small folder of tables."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus, test_licences, test_neargraph, test_secrets, test_simhash
from tests.llm.test_mainpage import ARTICLE
from vitarium.llm import mainpage, queries, secrets
from vitarium.session import scratch_path

TEXTS = [t for t in corpus.texts(3)] + [test_licences.MIT, "All rights reserved. CC BY 4.0", "ghp_" + "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5" + secrets.checksum(
    b"A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5").decode()]
DOCS = {i * 7 % 1009: t for i, t in enumerate(TEXTS)}


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "tables")

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")

    langs = ["en", "de", "fr", None]
    put("documents", [(i, t, langs[i % 4], "s", len(t or "")) for i, t in DOCS.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    x = test_neargraph.vectors(4, 80, 30, 12)[:200]
    put("embeddings", [(i, [float(np.float32(c)) for c in v], i % 10 if i % 23 else None) for i, v in enumerate(x) if np.abs(v).max() < 1e6]
        + [(900, None, 1), (950, [float("nan")] * 12, 2), (1000, [0.0] * 12, 3)], "vec_id bigint, embedding array<float>, label int")
    put("pages", [(1, "u", ARTICLE), (2, None, None), (3, "v", "<p>x")], "page_id bigint, url string, html string")
    rng = random.Random(1)
    put("conversations", [(c, t, rng.choice(["user", None]), rng.choice(["hi  you", "yes", None])) for c in range(60) for t in range(rng.randint(1, 5))],
        "conv_id bigint, turn bigint, role string, text string")
    return path


@pytest.fixture(scope="module")
def rows(spark, folder):
    cache = {}

    def of(name):
        if name not in cache:
            cache[name] = queries.QUERIES[name](spark, folder).collect()
        return cache[name]
    return of


def ids_of(name, text, end):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_every_query_is_numbered_or_the_pipeline():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(rows, folder, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    got = rows(name)
    assert set(got[0].__fields__) == set(columns)
    assert sorted([[r[c] for c in sorted(columns)] for r in got], key=repr) == sorted(
        [[v for _, v in sorted(zip(columns, r))] for r in want.fetchall()], key=repr)


def test_op2(rows):
    for r in rows("op2_bpe"):
        ids = ids_of(queries.WORD_BPE, DOCS[r.doc_id], 0)[:-1]
        text = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE)).decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op3(rows):
    got = rows("op3_neargraph")
    odd = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id >= 900}
    assert odd == {i: (0, i, True) for i in (900, 950, 1000)}
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and sum(r.n_links for r in got) > 100


def test_op4(rows):
    pieces = {}
    for r in rows("op4_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == DOCS.keys()
    for key, parts in pieces.items():
        ids, at = ids_of(queries.WORD_BPE, DOCS[key], 1), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)


def test_op5(rows):
    for r in rows("op5_secrets"):
        spans = test_secrets.brute(DOCS[r.doc_id] or "")
        text = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(r.spans.split(",")) if text else r.spans == "" or r.spans.startswith("github")
    assert any("github" in r.spans for r in rows("op5_secrets"))


def test_op6(rows):
    at, got = 0, {r.doc_id: r for r in rows("op6_idfiles")}
    for key in sorted(DOCS):
        ids = ids_of(queries.BYTE_BPE, DOCS[key], 2)
        assert (got[key].start, got[key].n_tokens, got[key].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_op7(rows):
    got = rows("op7_sharding")
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and {r.law for r in got} == {"rows"}
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in DOCS.items()}


def test_op8(rows):
    prints = {i: test_simhash.brute_print(t) for i, t in DOCS.items()}
    group = test_simhash.brute_groups(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[group[p]] = min(i, least.get(group[p], i))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows("op8_simhash")} == {
        (i, f"{p:016x}", least[group[p]]) for i, p in prints.items()}


def test_op9(rows):
    want = {1: mainpage.main_text(ARTICLE), 2: "", 3: mainpage.main_text("<p>x")}
    assert {(r.page_id, r.text, r.n_chars) for r in rows("op9_mainpage")} == {(i, t, len(t)) for i, t in want.items()}


def test_op10(rows):
    for r in rows("op10_langid"):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        letters = any(c.isalpha() for c in DOCS[r.doc_id] or "")
        assert (r.lang_pred in ("en", "de", "fr")) == letters and 0 <= r.score <= 1


def test_op12(rows):
    for r in rows("op12_licences"):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == test_licences.plain(DOCS[r.doc_id])
    assert {r.labels for r in rows("op12_licences")} == {"", "mit", "cc-by,reserved"}
