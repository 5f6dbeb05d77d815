import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus
from vitarium.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, documents, length):
    """Every document's ids in its pieces, in order; sequences gapless and full but for the last."""
    library = Tokenizer.from_file(PATH)
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,) for t in documents)
    got, places = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        got[r.sequence_id * length + r.offset - r.start, r.doc_tokens].append((r.start, *ids.tolist()))
        places[r.sequence_id].append((r.offset, r.length))
    whole = []
    for (_, n), pieces in got.items():
        ids = []
        for start, *piece in pieces:
            assert start == len(ids)
            ids += piece
        assert len(ids) == n
        whole.append(tuple(ids))
    assert sorted(whole) == want
    assert sorted(places) == list(range(len(places)))
    for sequence, spans in places.items():
        ends = list(itertools.accumulate(n for _, n in spans))
        assert [a for a, _ in spans] == [0, *ends[:-1]]
        assert ends[-1] == length or sequence == max(places)


@pytest.mark.parametrize("length", [64, 2048])
def test_every_id_once_in_full_sequences(spark, length):
    rows = packing.pack(corpus.frame(spark), PATH, length=length).collect()
    check(rows, [r[1] for r in corpus.rows()], length)


def test_same_packing_however_rows_are_dealt(spark):
    packed = lambda parts: corpus.rows_of(packing.pack(corpus.frame(spark, parts=parts), PATH).drop("ids"))
    assert packed(1) == packed(6)


def test_empty(spark):
    assert packing.pack(corpus.empty(spark), PATH).count() == 0


@pytest.mark.parametrize(("dims", "bits"), [(2, 1), (2, 4), (3, 3)])
def test_hilbert_curve_visits_every_cell_in_steps_of_one(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    line = points[np.argsort(keys)]
    assert (np.abs(np.diff(line, axis=0)).sum(axis=1) == 1).all()


def test_equal_texts_are_neighbours(spark):
    df = spark.createDataFrame([(i, ["the old house by the river", "die alte und neue Stadt", "12 34 56 78"][i % 3])
                                for i in range(30)], "doc_id bigint, text string")
    rows = sorted(packing.pack(df, PATH).collect(), key=lambda r: (r.sequence_id, r.offset))
    kinds = [r.doc_id % 3 for r in rows]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 2
