import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus
from tests.llm.test_tokens import HARD
from vitarium.llm import bpe
from vitarium.llm.tokens import BpeEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def sample():
    rng = random.Random(9)
    words = corpus.WORDS + ["naïve", "don't", "12,5", "<|endoftext|>", "é́", "  ", "\n", "日本語", "", "x" * 300]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(80)]
    return HARD + texts + ["".join(t.split()) for t in texts[:10]] + [a + b for a, b in zip(texts, texts[1:])]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("bits", [2, 5, 10])
def test_ids_equal_the_library_wherever_cuts_fall(monkeypatch, name, bits):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    path = public_tokenizers.path(name)
    library, codec, memo = Tokenizer.from_file(path), BpeEncoder(path), {}
    for part in (sample(), sample()[::-1]):
        for text, ids in zip(part, bpe.encode_texts(pa.array(part), codec, memo)):
            assert np.frombuffer(ids, codec.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:90])


def test_chunks_follow_the_content(monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", 5)
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefg hij") for _ in range(5000))
    one, two = (set(bpe.chunks(np.frombuffer((lead + body).encode(), np.uint8))) for lead in ("", "another beginning "))
    assert len(one & two) > 0.9 * len(one)


@pytest.mark.parametrize("piece", [40, 1 << 22])
def test_cuts_do_not_depend_on_pieces(monkeypatch, piece):
    data = np.random.default_rng(1).integers(0, 256, 20_000, dtype=np.uint8)
    monkeypatch.setattr(bpe, "CUT_BITS", 5)
    want = bpe.cuts(data)
    monkeypatch.setattr(bpe, "PIECE", piece)
    assert all((a == b).all() for a, b in zip(want, bpe.cuts(data)))


def test_operator_and_decoding(spark):
    library = Tokenizer.from_file(PATH)
    both = bpe.decode(bpe.encode(corpus.frame(spark), PATH), PATH).collect()
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in both), key=repr)
    ids = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in corpus.rows()]
    assert got == sorted(((k, x, library.decode(x, skip_special_tokens=False)) for k, x in ids), key=repr)
    assert bpe.encode(corpus.empty(spark), PATH).count() == 0


def test_query_digests(spark):
    from vitarium.llm.queries import op2_bpe

    library = Tokenizer.from_file(PATH)
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op2_bpe(spark, sf).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
