"""Exact, near, passage and line duplicates against plain versions."""

import random

import numpy as np
import plain
import pytest

from setwise.llm import exact_dedup, line_dedup, ngram_join, substrings
from setwise.llm.graph import components
from setwise.llm.words import Words

def test_words_and_hashes(messy):
    import pyarrow as pa

    texts = pa.array([t for _, t in messy])
    found = Words(texts)
    for i, (_, text) in enumerate(messy):
        at = range(found.first[i], found.first[i + 1])
        assert [found.data[found.starts[j] : found.ends[j]].tobytes().decode() for j in at] == plain.words(text)
    names = [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends)]
    assert len(set(names)) == len(set(zip(names, found.hashes.tolist()))) == len(set(found.hashes.tolist()))
    assert len(Words(texts.slice(3, 4)).hashes) == sum(len(plain.words(t)) for _, t in messy[3:7])


@pytest.mark.parametrize("cells", [1 << 26, 1024])
def test_exact_copies(docs, messy, cells):
    """With 1024 cells the texts are worked through in slices; the result is the same."""
    got = exact_dedup.copies(docs, max_cells=cells).collect()
    groups = {}
    for key, text in messy:
        groups.setdefault(text or "", []).append(key)
    want = []
    for text, keys in groups.items():
        best = max(keys, key=plain.own)
        rest = list(keys)
        rest.remove(best)
        want += [(k, best, len(keys), kept, plain.sha(text)) for k, kept in [(best, True), *[(k, False) for k in rest]]]
    assert plain.ordered((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == plain.ordered(want)
    kept = exact_dedup.without_copies(docs, max_cells=cells)
    assert kept.columns == docs.columns
    found = plain.ordered((r["doc_id"], plain.sha(r["text"] or "")) for r in kept.collect())
    assert found == plain.ordered((w[0], w[4]) for w in want if w[3])


def test_repeated_passages(docs, messy):
    got = [tuple(r) for r in substrings.without_repeats(docs).collect()]
    assert plain.ordered(got) == plain.without_repeats(messy)


@pytest.mark.parametrize("rare, least", [(8, 20), (50, 20), (200, 1)])
def test_repeated_lines(docs, messy, rare, least):
    got = line_dedup.without_repeated_lines(docs, rare, least).collect()
    assert plain.ordered(got) == plain.without_repeated_lines(messy, least)


def test_patience_blocks():
    dice = random.Random(2)
    for _ in range(300):
        a, b = ([dice.randrange(12) for _ in range(dice.randrange(15))] for _ in range(2))
        blocks = line_dedup.patience(a, b)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in blocks)
        assert {(i + k, j + k) for i, j, n in blocks for k in range(n)} == plain.matched_lines(a, b)


@pytest.mark.parametrize("crowd, block, cheap", [(64, 1000, 200), (5, 7, 0)])
def test_near_duplicates(docs, messy, monkeypatch, crowd, block, cheap):
    for name, value in (("CROWD", crowd), ("BLOCK", block), ("CHEAP", cheap)):
        monkeypatch.setattr(ngram_join, name, value)
    got = [tuple(r) for r in ngram_join.near_duplicates(docs).collect()]
    assert plain.ordered(got) == plain.near_duplicates(messy)


def test_one_of_each_near_duplicate_stays(docs, messy):
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = plain.near_groups(messy)
    wordless = [(k, t) for (k, t), g in zip(messy, groups) if not plain.words(t)]
    best = {}
    for (k, t), g in zip(messy, groups):
        if plain.words(t):
            best.setdefault(g, []).append((k is None, k, t))
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert plain.ordered(r for r in found if not plain.words(r[1])) == plain.ordered(wordless)
    stay = [r for r in found if plain.words(r[1])]
    assert len(stay) == len(best)
    for rows in best.values():
        least = min((r[0], r[1] or 0) for r in rows)
        assert sum((k is None, k, t) in rows and (k is None, k or 0) == least for k, t in stay) == 1


def test_rows_that_share_an_id_or_have_none(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, a), (2, a + " x"), (None, a), (None, a + " y"), (7, b), (7, a), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = ngram_join.without_near_duplicates(docs)
    assert plain.ordered(kept.collect()) == plain.ordered([(1, a), (7, b), (None, None), (3, ""), (3, "")])


def test_prefixes_hold_their_promise():
    """Linked sets share as many elements in their prefixes as the shorter one asks for."""
    dice = np.random.default_rng(3)
    for _ in range(2000):
        n = int(dice.integers(1, 120))
        x = set(dice.choice(1000, n, replace=False).tolist())
        y = {v for v in x if dice.random() < 0.9} | set(dice.integers(1000, 2000, int(dice.integers(0, n // 5 + 1))).tolist())
        if not y or 100 * len(x & y) < 75 * len(x | y):
            continue
        small, large = sorted((x, y), key=len)
        m = [ngram_join.first_matches(len(s)) for s in (small, large)]
        as_small = sorted(small)[: len(small) - ngram_join.needed_smaller(len(small)) + m[0]]
        as_large = sorted(large)[: len(large) - ngram_join.needed(len(large)) + m[1]]
        assert len(set(as_small) & set(as_large)) >= min(m)


def test_components(spark):
    dice = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 40)]
    links += [(dice.randrange(300, 400), dice.randrange(300, 400)) for _ in range(50)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    group = plain.groups(400, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: min(y for y in nodes if group[y] == group[x]) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_empty_tables(nothing):
    assert exact_dedup.copies(nothing).isEmpty() and exact_dedup.without_copies(nothing).isEmpty()
    assert substrings.without_repeats(nothing).isEmpty() and line_dedup.without_repeated_lines(nothing).isEmpty()
    assert ngram_join.near_duplicates(nothing).isEmpty() and ngram_join.without_near_duplicates(nothing).isEmpty()
