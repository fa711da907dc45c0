"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from setwise.llm import ranking

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(PATTERN, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items):
    bags = [(key, Counter(terms(text))) for key, text in docs]
    bags = [(key, bag) for key, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(sum(bag.values()) for _, bag in bags)
    holders = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        wanted = set(terms(text))
        scored = []
        for key, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in wanted if bag[t]
            )
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, key, -score) for i, (score, _, _, key) in enumerate(sorted(scored)[:10])]
    return sorted(out, key=repr)


ITEMS = [
    (1, "w1 w2 W3 w20 w35"), (2, "the THE the. w5"), (3, None), (4, ""), (5, "nowhere to be found"), (6, "été Straße 漢字 one"), (7, "w9"),
    (7, "w9 w8"), (None, "w3 w4 w5 w6 w7 w8 w9 w10 w11"), (8, " ".join(f"w{i}" for i in range(40))), (9, "x" * 3000), (9, "w1 w2 W3 w20 w35"),
]
SCHEMA = "item_id long, text string, item string, terms string, rank int, score int"


def items_frame(spark, rows):
    return spark.createDataFrame([(k, t, "i", "t", 1, 2) for k, t in rows], SCHEMA)


@pytest.mark.parametrize("shard, max_terms", [(8 << 20, 1 << 20), (2000, 30)])
def test_best_documents(spark, docs, messy, monkeypatch, shard, max_terms):
    monkeypatch.setattr(ranking, "SHARD_BYTES", shard)
    got = ranking.search(docs, items_frame(spark, ITEMS), max_terms=max_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(messy, ITEMS)


def test_many_texts_of_other_lengths(spark, monkeypatch):
    """Skewed words, long and short texts, ties, in shards of a few documents."""
    monkeypatch.setattr(ranking, "SHARD_BYTES", 6000)
    dice = random.Random(9)
    word = lambda: f"t{int(dice.paretovariate(0.7)) % 500}"
    rows = [(i, " ".join(word() for _ in range(int(dice.paretovariate(0.6)) % 400))) for i in range(600)]
    rows += [(1000 + i, rows[i % 40][1]) for i in range(200)]
    asked = [(i, " ".join(word() for _ in range(dice.randint(1, 25)))) for i in range(60)]
    got = ranking.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), items_frame(spark, asked)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows, asked)


def test_empty_tables(spark, docs, nothing):
    items = items_frame(spark, ITEMS)
    assert ranking.search(nothing, items).isEmpty() and ranking.search(docs, items.limit(0)).isEmpty()
    assert ranking.search(docs, items.where("item_id = 3")).isEmpty()


def test_bounds_hold_and_pairs_tighten_them():
    dice = random.Random(2)
    tighter = 0
    for _ in range(300):
        k = dice.randint(1, 7)
        rows = [[dice.choice([0, 0, dice.randint(1, 50)]) for _ in range(k)] for _ in range(12)]
        most = [max(r[i] for r in rows) for i in range(k)]
        joint = [max([r[i] + r[i + 1] for r in rows if r[i] and r[i + 1]], default=0) for i in range(k - 1)]
        bounds = ranking.suffix_bounds(most, joint)
        assert all(bounds[i] >= max(sum(r[i:]) for r in rows) for i in range(k + 1))
        assert all(bounds[i] <= sum(most[i:]) for i in range(k + 1))
        tighter += bounds[0] < sum(most)
    assert tighter > 100


def test_length_factors_beyond_64_bits():
    import numpy as np

    sizes = np.array([10**9, 5], dtype=np.int64)
    assert ranking.shortness(sizes, 10**10, 10**13).tolist() == [10 + 90 * 10**19 // 10**13, 10]
