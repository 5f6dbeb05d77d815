import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import corpus
from vitarium.llm import tokens
from vitarium.llm.tokens import BpeEncoder

HARD = ["", "  a  b ", "a\n b", "a \nb", "a\n\nb c\n", "x<|endoftext|> y", "foo\n <|endoftext|> bar", "don't DON'T we'll 're",
        "naïve CAFÉ × ÷ ßÿ ÿÀ", "á é́  z", "日本語 テスト 123 4567 ¹²", "aaa aaaa aaaaaaa AAAAA", "tab\tx\ty a\t b", "\n", "\n\n", " ",
        "a\r\nb\r\n c", "İstanbul ΣΑΣ ſ", "x\0y z\0", "...!!! ?! a1b2 12.5%", "ÃƒÂ© Ã", "end \n", "end\n ", "a \n\n b"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("chars", [5, 1 << 21])
def test_ids_equal_the_library(name, chars, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_CHARS", chars)
    path = public_tokenizers.path(name)
    rng = random.Random(1)
    letters = "ab'’ \n\té1.,-!<|>Ǆ́𝒳"
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [t or "" for t in corpus.texts()]
    library, mine = Tokenizer.from_file(path), BpeEncoder(path, memo_words=50)
    for some in (texts[:40], texts):
        for text, ids in zip(some, mine.encode(some)):
            assert np.frombuffer(ids, mine.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_of_every_length_and_in_any_company(name):
    path = public_tokenizers.path(name)
    rng = random.Random(5)
    words = ["".join(rng.choice(some) for _ in range(n)) for n in range(1, 300) for some in ("a", "aé", "thion", "nedgqxàT", "ab1.,")]
    texts = [*words, " ".join(words), " ".join(f"{a},{b}" for a, b in zip(words, reversed(words)))]
    library, mine = Tokenizer.from_file(path), BpeEncoder(path)
    for text, ids in zip(texts, mine.encode(texts)):
        assert np.frombuffer(ids, mine.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_met_once_do_not_drive_out_those_met_again(monkeypatch):
    mine = BpeEncoder(public_tokenizers.path("byte_bpe_50k.json"), memo_words=100)
    merged = []
    once = BpeEncoder._merge_words
    monkeypatch.setattr(BpeEncoder, "_merge_words", lambda self, flat, kind, starts, ends: (
        merged.append(len(starts)), once(self, flat, kind, starts, ends))[1])
    rng = random.Random(6)
    again = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(20)]
    for _ in range(8):
        new = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(90)]
        mine.encode([" ".join(["x", *again, *new, *again])])
    assert sum(merged) <= 8 * 90 + 20 + 8  # all one-off words, the others but once, a first word a text
