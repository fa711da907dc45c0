"""Every character that a text can have, against the tokenizer's own library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from setwise.llm import bpe

POINTS = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]


@pytest.fixture(scope="module")
def both():
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.WordVocabulary(path), Tokenizer.from_file(path)


def ids(vocabulary, text):
    return [vocabulary.id_of(t) for word in vocabulary.words(text) for t in vocabulary.encode_word(word)]


def test_every_code_point(both):
    vocabulary, library = both
    texts = [f"a{chr(c)}B" for c in POINTS]
    for at in range(0, len(texts), 50_000):
        part = texts[at : at + 50_000]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [t for t, w in zip(part, want) if ids(vocabulary, t) != w] == []


def test_neighbours_of_all_kinds(both):
    """Marks, letters that compose, digits and new characters side by side."""
    vocabulary, library = both
    dice = random.Random(5)
    common = "aÉ'sΣß1²½ ̣́ͅ각한字ǅⅠⒶ'"
    texts = ["".join(dice.choice(common) if dice.random() < 0.6 else chr(dice.choice(POINTS)) for _ in range(dice.randint(1, 12))) for _ in range(60_000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, w in zip(texts, want) if ids(vocabulary, t) != w] == []
