"""Repeated lines once more, in plain Python, with every earlier document as a partner."""

from __future__ import annotations

from plain import own, words

STRIP = " \t\n\r\x0b\x0c"


def lines_of(text):
    return [x.strip(STRIP) for x in (text or "").split("\n") if x.strip(STRIP)]


def removed(docs, matched, least_words=20):
    """Per id the numbers of the lines in blocks that any earlier document has in order."""
    lines = {own(key): lines_of(text) for key, text in docs}
    out = {}
    for key, seq in lines.items():
        gone = set()
        for before in (k for k in lines if k < key):
            block = []
            for i, j in [*sorted(matched(lines[before], seq)), (-1, -1)]:
                if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
                    if sum(len(words(seq[y])) for _, y in block) >= least_words:
                        gone.update(y for _, y in block)
                    block = []
                block.append((i, j))
        out[key] = len(gone)
    return out


def matched(a, b, size):
    """Patience diff; a gap without unique common lines is split at its run of most words."""
    a0, b0, a1, b1, out = 0, 0, len(a), len(b), set()
    while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
        out.add((a0, b0))
        a0, b0 = a0 + 1, b0 + 1
    while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
        a1, b1 = a1 - 1, b1 - 1
        out.add((a1, b1))
    cuts = [(a0, b0, 0), (a1, b1, 0)]
    unique = [x for x in a[a0:a1] if a[a0:a1].count(x) == 1 == b[b0:b1].count(x)]
    if unique:
        # Longest increasing run: for each length the run that ends lowest.
        runs = []
        for i, j in [(a.index(x, a0), b.index(x, b0)) for x in unique]:
            k = next((k for k, run in enumerate(runs) if run[-1][1] > j), len(runs))
            runs[k : k + 1] = [(runs[k - 1] if k else []) + [(i, j)]]
        cuts[1:1] = [(i, j, 0) for i, j in runs[-1]]
    else:
        best = (0, 0, 0, 0)
        for i in range(a0, a1):
            for j in range(b0, b1):
                n = 0
                while i + n < a1 and j + n < b1 and a[i + n] == b[j + n]:
                    n += 1
                best = max(best, (sum(map(size, a[i : i + n])), -j, -i, n))
        if best[0] == 0:
            return out
        cuts[1:1] = [(-best[2], -best[1], best[3])]
    for (i, j, n), (p, q, _) in zip(cuts, cuts[1:]):
        out |= {(i + k, j + k) for k in range(n)}
        out |= {(i + n + x, j + n + y) for x, y in matched(a[i + n : p], b[j + n : q], size)}
    return out


def blocks_of(pairs):
    """Matched pairs as blocks of neighbours: begin on both sides and length."""
    out = []
    for i, j in sorted(pairs):
        if out and (i, j) == (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, j, 1))
    return out
