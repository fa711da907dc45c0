"""Which documents the mix takes, and what the rules' votes decide, against plain versions."""

import math
import struct
from collections import Counter, defaultdict

import plain
import pytest
import xxhash
from conftest import DATA

from setwise.llm import mixing, quality

# --- mixing -------------------------------------------------------------------------


def draw(key, weight, seed):
    """An exponential key: the hash of seed and id as a number between 0 and 1, by weight."""
    found = xxhash.xxh64(struct.pack("<i", seed), seed=42).intdigest()
    if key is not None:
        found = xxhash.xxh64(struct.pack("<q", key), seed=found).intdigest()
    return -math.log(((found >> 12) + 0.5) / (1 << 52)) / weight


def selected(rows, weights, targets, seed):
    """How often each (id, source, size) is taken. Sorts every source by key."""
    times = Counter(rows)
    by_source = defaultdict(list)
    for (key, source, size), n in times.items():
        place = draw(key, weights.get(key, 1.0), seed), plain.own(key), size
        by_source[source].append((place, key, size, n))
    out = {}
    for source, units in by_source.items():
        total = sum(size * n for _, _, size, n in units)
        epochs = int(targets[source] // total) if total else 0
        rest, so_far, going = targets[source] - epochs * total, 0, True
        for _, key, size, n in sorted(units):
            # Until the total comes nearest; later ones stay out, also those without words.
            going = going and so_far <= rest and abs(so_far + size * n - rest) <= abs(so_far - rest)
            out[key, source, size] = epochs + going
            so_far += size * n
    return [(*unit, out[unit]) for unit, n in times.items() for _ in range(n)]


def document_weights(labels):
    given = defaultdict(list)
    for key, label in labels:
        if label is not None:
            given[key].append(2.0 if label else 0.5)
    return {key: sum(w) / len(w) for key, w in given.items()}


def check_mix(docs, labels, seed):
    rows = [(r["doc_id"], r["source"], len(plain.words(r["text"]))) for r in docs.select("doc_id", "source", "text").collect()]
    weights = document_weights([(r["doc_id"], r["quality"]) for r in labels.collect()]) if labels else {}
    got = mixing.mix(docs, labels, seed=seed).collect()
    targets = {r["source"]: r["target"] for r in got}
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    assert targets == pytest.approx(plain.targets(sizes, dict(zip(order, [1, 2, 3] * len(order)))))
    taken = [(r["doc_id"], r["source"], r["size"], r["copies"]) for r in got]
    assert plain.ordered(taken) == plain.ordered(selected(rows, weights, targets, seed))
    assert len({t[3] for t in taken}) > 1


@pytest.mark.parametrize("seed", [0, 3, 8])
def test_selection_by_keys(docs, seed):
    check_mix(docs, None, seed)


def test_selection_by_keys_and_labels(spark):
    check_mix(spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet"), 0)


def test_selection_with_odd_labels(spark, docs):
    labels = [(100, 1), (100, 0), (101, None), (102, 0), (None, 1), (103, 1), (103, 1), (5000, 0), (7, 0)]
    # A null id has no label, as it equals no other.
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    check_mix(docs, given.where("doc_id IS NOT NULL"), 1)
    assert plain.ordered(mixing.mix(docs, given, seed=1).collect()) == plain.ordered(mixing.mix(docs, given.where("doc_id IS NOT NULL"), seed=1).collect())


# --- quality ------------------------------------------------------------------------


def votes(text):
    text, words = text or "", plain.words(text)
    n_words, chars, symbols, dup_lines, repeated = plain.measures(text)
    letters = [c for c in text if c.isascii() and c.isalpha() or not c.isascii()]
    lines = [x for x in text.split("\n") if plain.words(x)]
    bare = [w for w in words if all(c.isascii() and not c.isalpha() for c in w)]
    rates = [
        (symbols, n_words, 0.02, 0.1),
        (symbols, chars, 0.01, 0.05),
        (None if not chars else 1 - len(letters) / chars, 1, 0.1, 0.2),
        (len(bare), n_words, 0.05, 0.2),
        (sum("A" <= c <= "Z" for c in text), len(letters), 0.15, 0.4),
        (text.count("!"), n_words, 0.02, 0.2),
        (repeated, n_words, 0.1, 0.3),
        (dup_lines, len(lines), 0.25, 0.5),
        (len(set(words)), math.sqrt(n_words), 2.5, 1.5),
    ]
    out = []
    for part, of, good, bad in rates:
        if part is None or not of:
            out.append(0)
        elif good < bad:
            out.append((part / of <= good) - (part / of >= bad))
        else:
            out.append((part / of >= good) - (part / of <= bad))
    return out


def posteriors(all_votes, prior_rows=20):
    """Expectation-maximisation, document by document."""
    k = len(quality.RULES)
    prior, on_good, on_bad = 0.85, [0.97] * k, [0.6] * k

    def posterior(own):
        good, bad = prior, 1 - prior
        for vote, a, b in zip(own, on_good, on_bad):
            good *= {1: a, -1: 1 - a, 0: 1}[vote]
            bad *= {1: 1 - b, -1: b, 0: 1}[vote]
        return good / (good + bad)

    for _ in range(200):
        p = [posterior(v) for v in all_votes]
        before = [prior, *on_good, *on_bad]
        prior = min(max((sum(p) + 0.85 * prior_rows) / (len(p) + prior_rows), 0.5), 0.99)
        for r in range(k):
            cast = [(v[r], x) for v, x in zip(all_votes, p) if v[r]]
            right_good, right_bad = sum(x for v, x in cast if v > 0), sum(1 - x for v, x in cast if v < 0)
            on_good[r] = min(max((right_good + 0.97 * prior_rows) / (sum(x for _, x in cast) + prior_rows), 0.55), 0.999)
            on_bad[r] = min(max((right_bad + 0.6 * prior_rows) / (sum(1 - x for _, x in cast) + prior_rows), 0.1), 0.999)
        if max(abs(a - b) for a, b in zip(before, [prior, *on_good, *on_bad])) < 1e-6:
            break
    return [posterior(v) for v in all_votes]


def check_verdicts(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    wanted = []
    for (key, text), p in zip(rows, posteriors([votes(t) for _, t in rows])):
        measured = plain.measures(text)
        failed = measured[0] < 20 or 100 * measured[4] > 30 * measured[0]
        assert abs(p - 0.5) > 1e-4  # so that rounding decides no verdict
        wanted.append((key, *measured, failed, not failed and p >= 0.5, round(p, 4)))
    got = quality.judge(docs).collect()
    names = ("doc_id", *quality.BASE, "base_failed", "kept")
    got = plain.ordered((*(r[c] for c in names), r["quality"]) for r in got)
    wanted = plain.ordered(wanted)
    assert [g[:-1] for g in got] == [w[:-1] for w in wanted]
    assert [g[-1] for g in got] == pytest.approx([w[-1] for w in wanted], abs=2e-4)
    return got


def test_verdicts(docs):
    check_verdicts(docs)


def test_verdicts_of_documents(spark):
    assert {g[-2] for g in check_verdicts(spark.read.parquet(f"{DATA}/documents.parquet"))} == {True, False}
