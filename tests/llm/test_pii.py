"""Base spans against the plain patterns; estimates and added spans on planted texts."""

import random
import re

import numpy as np
import plain
import pytest

from setwise.llm import pii

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 8 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(k, m.group())]


def test_base_spans():
    dice = random.Random(6)
    pieces = ["a.b", "@", "x-1", ".", "..", "com", " ", "+", "-", "12", "4", "255", "256", "0", "(", ")", "é", "漢", "1.2.3.4", "+1 (988) 555-2485",
              "4041894974608795", "4041 8949 7460 8795", "bo.t@mail.example.com", "@b.c", "a@", "007", "\n", "+49 30", "%"]
    seen = set()
    for _ in range(20000):
        text = "".join(dice.choice(pieces) for _ in range(dice.randint(1, 14)))
        want = plain_spans(text)
        assert [tuple(s) for s in pii.base_spans(text)] == want, text
        seen.update(k for k, _, _ in want)
    assert seen == {0, 1, 2, 3}


@pytest.mark.parametrize("run", ["a", "1", "1.", "+1", "a@", "(", "1 ", "@", "a.b-", "::1", "0"])
def test_long_runs_take_linear_time(run):
    import time

    started = time.time()
    pii.labeled(run * (1_000_000 // len(run)))
    assert time.time() - started < 60


FOUND = [
    ("phone", "you can call (212) 555-01{:02d} today", "(212) 555-01{:02d}"), ("email", "write to jo{:02d} (at) mail (dot) com now", "jo{:02d} (at) mail (dot) com"),
    ("card", "my amex card 3400 123456 78{:03d}", None),
]
LEFT = ["see order 20240117{:04d}55 for it", "key = a3a1b97e25e5c105974300534{:04d}d08a", "at 12:30:{:02d} we left", "isbn 978-0-306-40{:03d}-7 here", "from 1987-1991 some {:02d} rows"]


def corpus():
    dice = random.Random(8)
    rows = []
    for i in range(240):
        kind = i % 4
        own = [f"mail bo{i}@mail{i % 9}.example.com please", f"the host {1 + i % 200}.7.{i % 250}.9 is up", "4041894974608795 is it", f"phone +1 (988) 555-{1000 + i} for me"]
        rows.append((i, " ".join([f"w{dice.randrange(50)}" for _ in range(9)] + [own[kind]] + [f"w{dice.randrange(50)}" for _ in range(4)])))
    rows += [(1000 + i, "so " + FOUND[i % 2][1].format(i) + " then") for i in range(40)]
    rows += [(2000 + i, "so " + LEFT[i % len(LEFT)].format(i) + " then") for i in range(100)]
    return rows


def test_added_spans(spark):
    rows = corpus()
    texts = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in pii.find_spans(docs).collect()}
    assert len(got) == len(rows)
    for key, r in got.items():
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(texts[key]))
        assert r["base"] == base
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        shown = [(k, texts[key][int(a) : int(b)]) for k, a, b in spans]
        if 1000 <= key < 2000:
            name, _, form = FOUND[key % 2]
            assert shown == [(name, form.format(key - 1000))]
        else:
            assert r["spans"] == base and r["n_added"] == 0


def test_estimates_find_reliabilities():
    """Votes drawn with known accuracies: the estimate comes near them and the truth."""
    dice = np.random.default_rng(4)
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6, 0.85])
    truth = dice.random(20000) < 0.4
    votes = np.where(dice.random((20000, 6)) < right, 1, -1) * np.where(truth, 1, -1)[:, None] * (dice.random((20000, 6)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = pii.reliability(patterns, counts)
    assert np.abs(model.on_yes - right).max() < 0.04 and np.abs(model.on_no - right).max() < 0.04 and abs(model.prior - 0.4) < 0.03
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_classifier_follows_posteriors():
    dice = random.Random(3)
    features = [[dice.randrange(4), 10 + dice.randrange(3)] for _ in range(500)]
    wanted = np.array([0.95 if f[0] < 2 else 0.05 for f in features])
    model = pii.Model(pii.fit_classifier(features, wanted, np.ones(500)), {})
    assert model.probability([0, 10]) > 0.85 and model.probability([3, 11]) < 0.15


def test_odd_rows(spark, docs, messy, nothing):
    got = pii.find_spans(docs)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans", "n_added"]
    want = []
    for key, text in messy:
        spans = plain_spans(text)
        want.append((key, *[sum(k == s[0] for s in spans) for k in range(4)], ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)))
    assert plain.ordered(tuple(r)[:6] for r in got.collect()) == plain.ordered(want)
    assert pii.find_spans(nothing).isEmpty()


def test_spans_do_not_depend_on_the_order_of_rows(spark):
    rows = corpus()
    one, two = (spark.createDataFrame(r, "doc_id long, text string").repartition(n) for r, n in ((rows, 2), (rows[::-1], 7)))
    assert plain.ordered(pii.find_spans(one, sample=5).collect()) == plain.ordered(pii.find_spans(two, sample=5).collect())
