"""Token counts of text without spaces: maps of states, composed chunk by chunk."""

import base64
import random

import pytest

from setwise.llm import token_counts
from setwise.llm.queries import vocabulary

PIECES = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.Pieces.from_model(vocabulary(PIECES)))


def unsplit(dice, n):
    """Text of few or no spaces that is hard in different ways."""
    kinds = [
        lambda: base64.b64encode(dice.randbytes(n)).decode()[:n],
        lambda: dice.choice(["a", "=", "-", "\u4e2d", "ab", "the"]) * n,
        lambda: "".join(dice.choice("\u4e2d\u6587\u5b57\u7684\u662f\u00e9\U0001f642") for _ in range(n)),
        lambda: "".join(dice.choice(["the", "ing", "er", "s", "", "n", " "] if i % 97 == 0 else ["the", "ing", "er", "s"]) for i in range(n)),
        lambda: " " * dice.randrange(40) + "x" * n + " " * dice.randrange(40),
    ]
    return dice.choice(kinds)()


def cut(text, size):
    """Chunks with the characters before them, as the query cuts them."""
    padded = " " + text
    for at in range(0, len(text), size):
        yield padded[at + 1 : at + 1 + size], padded[max(0, at + 1 - token_counts.CONTEXT) : at + 1]


def test_composed_maps_count_like_the_library(library, counter):
    dice = random.Random(11)
    for _ in range(60):
        text = "".join(unsplit(dice, dice.randrange(1, 900)) for _ in range(dice.randint(1, 3)))
        chunks = [counter.chunk(*c) for c in cut(text, dice.choice([40, 300, 700]))]
        want = len(library.encode(text))
        assert counter.finish(counter.scan(chunks)) == counter.text(text) == want
        order = chunks[0]  # composition is associative
        for c in chunks[1:]:
            order = counter.compose(order, c)
        assert counter.finish(order) == want


def test_a_chunk_reached_in_another_state_is_counted_anew(library, counter):
    dice = random.Random(12)
    for _ in range(20):
        text = unsplit(dice, 1500)
        chunks = [counter.chunk(c, dice.choice(["q", "a" * 9, "zz z", "\u4e2d"])) for c, _ in cut(text, 500)]
        # What a chunk is told of its start may be wrong, but not that it is the first.
        assert counter.finish(counter.scan(chunks)) == len(library.encode(text))


def test_maps_are_met_in_states_they_know(counter, monkeypatch):
    """What is left to do when chunks are composed does not grow with them."""
    dice = random.Random(13)
    texts = [base64.b64encode(dice.randbytes(60_000)).decode(), "a" * 60_000, "".join(dice.choice("\u4e2d\u6587\u5b57") for _ in range(60_000))]
    for text in texts:
        chunks = [counter.chunk(*c) for c in cut(text, 5_000)]
        done = []
        follow = token_counts.Transducer.follow
        monkeypatch.setattr(token_counts.Transducer, "follow", lambda self, state, run: done.append(len(run)) or follow(self, state, run))
        counter.finish(counter.scan(chunks))
        monkeypatch.undo()
        assert sum(done) < len(text) / 10


def test_few_states(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 60)
    counter, dice = token_counts.Counter(token_counts.Pieces.from_model(vocabulary(PIECES))), random.Random(14)
    for _ in range(10):
        text = unsplit(dice, 900)
        assert counter.finish(counter.scan([counter.chunk(*c) for c in cut(text, 400)])) == len(library.encode(text))


def test_five_million_characters_without_a_space(spark, library):
    dice = random.Random(15)
    run = base64.b64encode(dice.randbytes(3_750_000)).decode()
    rows = [(1, run), (1, run), (2, "a" * 200_001), (3, ("\u4e2d\u6587" * 70_000) + " end "), (None, "x" * 65_536), (4, " " * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = token_counts.count_tokens(docs, vocabulary(PIECES)).collect()
    want = [(k, len(t.encode()), len(library.encode(t))) for k, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
