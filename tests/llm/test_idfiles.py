import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus
from vitarium.llm import idfiles, rans
from vitarium.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 70_000])
@pytest.mark.parametrize("kinds", [1, 2, 300, 60_000])
def test_blocks_come_back(n, kinds):
    rng = np.random.default_rng(n + kinds)
    blocks = [(rng.zipf(1.3, k) % kinds).astype("<u4") for k in (n, 3, n // 2)]
    back = list(rans.decode_segment(rans.encode_segment(blocks)))
    assert [b.tolist() for b in back] == [b.tolist() for b in blocks]


def test_every_checkpoint_starts_a_part():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50, 5000)
    table = rans.Table.of(ids)
    at, states, words = rans.encode_block(table.places(ids), table, lanes=8, every=16)
    assert len(at) == len(states) == -(-5000 // 128)
    for k in random.Random(2).sample(range(len(at)), 10):
        part = rans.decode_part(words.astype(np.uint64), int(at[k]), states[k], table, table.symbols(), k * 128,
                                min(5000, (k + 1) * 128))
        assert (table.ids[part] == ids[k * 128:(k + 1) * 128]).all()


def test_skewed_ids_take_about_their_entropy():
    ids = (np.random.default_rng(3).zipf(1.5, 200_000) % 1000).astype("<u4")
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    least = -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(rans.encode_segment([ids])) < 1.08 * least + 8 * rans.LANES * 4


def test_damage_is_noticed():
    raw = bytearray(rans.encode_segment([np.arange(5000).astype("<u4") % 700]))
    raw[-3000] ^= 1
    with pytest.raises(ValueError):
        list(rans.decode_segment(bytes(raw)))
    with pytest.raises(ValueError):
        list(rans.decode_segment(b"else" + bytes(raw)))


@pytest.mark.parametrize(("segment", "block"), [(4 << 20, 1 << 18), (500, 90)])
def test_files_hold_every_document_in_order(spark, monkeypatch, segment, block):
    monkeypatch.setattr(idfiles, "SEGMENT", segment)
    monkeypatch.setattr(idfiles, "BLOCK", block)
    path = scratch_path(spark, "ids")
    idfiles.write_ids(corpus.frame(spark, parts=4), path, PATH, end_id=2)
    rows = sorted(idfiles.read_ids(spark, path).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    order = sorted(corpus.rows(), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode())))
    at = 0
    for r, (key, text, *_) in zip(rows, order, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (key, at, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        at += len(ids)


def test_empty(spark):
    path = scratch_path(spark, "ids")
    idfiles.write_ids(corpus.empty(spark), path, PATH, end_id=2)
    assert idfiles.read_ids(spark, path).count() == 0
