"""Byte-pair merging of a list of symbols, shared by the token operators.

Merging takes the pair of best rank, leftmost first, until no pair has a rank. A sequence of
tokens is the encoding of its text if and only if every two neighbours are the encoding of
theirs: what happens in a region depends on nothing outside as long as no merge crosses its
ends. Both operators rest on that.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

Rank = Callable[[str, str], float]
"""Rank of a pair of neighbours, smaller first; ``NEVER`` if they do not merge."""

NEVER = float("inf")
SHORT = 40


def merge(symbols: list[str], rank: Rank) -> list[str]:
    return _merge_short(symbols, rank) if len(symbols) <= SHORT else _merge_long(symbols, rank)


def _merge_short(symbols: list[str], rank: Rank) -> list[str]:
    parts, ranks = list(symbols), list(map(rank, symbols, symbols[1:]))
    while ranks and (best := min(ranks)) != NEVER:
        at = ranks.index(best)  # the leftmost
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del ranks[at]
        if at:
            ranks[at - 1] = rank(parts[at - 1], parts[at])
        if at < len(ranks):
            ranks[at] = rank(parts[at], parts[at + 1])
    return parts


def _merge_long(symbols: list[str], rank: Rank) -> list[str]:
    """The same with a heap over linked neighbours."""
    parts: list[str | None] = list(symbols)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := rank(parts[i], parts[j])) != NEVER:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue  # one of the two has merged since
        parts[i], parts[j] = a + b, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]
