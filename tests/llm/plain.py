"""The corpus operators once more, in plain Python over lists, to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

LEAST = -(1 << 63)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def own(key):
    return LEAST if key is None else key


def groups(n, links):
    """The group of each of n things, by links between them."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near_groups(docs, sets=None):
    """The group of each row."""
    sets = shingle_sets(docs) if sets is None else sets
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    links = []
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j > i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)]
    return groups(len(docs), links)


def shingle_sets(docs):
    sets = []
    for _, text in docs:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return sets


def near_duplicates(docs):
    sets = shingle_sets(docs)
    group = near_groups(docs, sets)
    first = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            first[group[i]] = min(first.get(group[i], key), key)
    return ordered((key, len(sets[i]), first.get(group[i]) if sets[i] else key) for i, (key, _) in enumerate(docs))


def without_repeats(docs, size=20):
    tokens = [words(text) for _, text in docs]
    first = {}
    for i in sorted(range(len(docs)), key=lambda i: own(docs[i][0])):
        for p in range(len(tokens[i]) - size + 1):
            first.setdefault(tuple(tokens[i][p : p + size]), (own(docs[i][0]), p))
    out = []
    for (key, _), w in zip(docs, tokens):
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < (own(key), p):
                gone.update(range(p, p + size))
        out.append((key, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return ordered(out)


def measures(text):
    text, w = text or "", words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def matched_lines(a, b):
    """Patience diff by the definition: equal ends, then unique common lines in order."""
    out, a0, b0, a1, b1 = set(), 0, 0, len(a), len(b)
    while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
        out.add((a0, b0))
        a0, b0 = a0 + 1, b0 + 1
    while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
        a1, b1 = a1 - 1, b1 - 1
        out.add((a1, b1))
    unique = [x for x in a[a0:a1] if a[a0:a1].count(x) == 1 == b[b0:b1].count(x)]
    if not unique:
        return out
    pairs = [(a.index(x, a0), b.index(x, b0)) for x in unique]
    # Longest increasing run: for each length the run that ends lowest, as patience sorting has it.
    runs = []
    for i, j in pairs:
        k = next((k for k, run in enumerate(runs) if run[-1][1] > j), len(runs))
        runs[k : k + 1] = [(runs[k - 1] if k else []) + [(i, j)]]
    cuts = [(a0, b0), *runs[-1], (a1, b1)]
    for (i, j), (p, q) in zip(cuts, cuts[1:]):
        out |= {(i + x, j + y) for x, y in matched_lines(a[i:p], b[j:q])}
    return out


def without_repeated_lines(docs, least_words):
    """Every earlier document is aligned, and gaps without anchors are split."""
    from plain_lines import matched

    strip = " \t\n\r\x0b\x0c"
    lines = {own(key): [x.strip(strip) for x in (text or "").split("\n") if x.strip(strip)] for key, text in docs}
    out = []
    for key, text in docs:
        k, seq = own(key), lines[own(key)]
        gone = set()
        for first in (f for f in lines if f < k and not set(lines[f]).isdisjoint(seq)):
            for i, j, n in blocks_of(matched(lines[first], seq, lambda s: len(words(s)))):
                if sum(len(words(x)) for x in seq[j : j + n]) >= least_words:
                    gone.update(range(j, j + n))
        left, at = [], -1
        for x in (text or "").split("\n"):
            at += bool(x.strip(strip))
            if at not in gone:
                left.append(x)
        out.append((key, len(seq), len(gone), "\n".join(left)))
    return ordered(out)


def blocks_of(pairs):
    """Matched pairs as blocks of neighbours: begin on both sides and length."""
    out = []
    for i, j in sorted(pairs):
        if out and (i, j) == (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, j, 1))
    return out


def targets(sizes, weights, cap=3):
    """Shares by weight, no more than ``cap`` times the size; the excess is shared again."""
    total, out, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        sharing = sum(weights[s] for s in sizes if s not in full)
        out = {s: cap * sizes[s] if s in full else left * weights[s] / sharing for s in sizes}
        above = {s for s in sizes if s not in full and out[s] > cap * sizes[s]}
        if not above:
            return out
        full |= above
