"""Repeated passages by relative Lempel-Ziv parsing against all earlier text.

The reference is every text that comes earlier: a smaller id, or the same text further up.
It is indexed in blocks. Each window of ``WINDOW`` words is anchored at the smallest hash
among its shingles of ``SHINGLE`` words; a block is the run of windows with one anchor, and
two equal windows always have equal anchors.

* Parsing: a block that equals an earlier block is taken whole, as a factor of the text. This
  covers the inside of every repeated passage with one row per block.
* Factor boundaries: where an anchor is known from elsewhere but its block differs, a factor
  begins or ends inside the block. Its windows are looked up one by one, among the windows of
  all such blocks.

Factors and single windows that are found become spans, and every word in a span goes. Both
look-ups are one shuffle by hash. Rows that share a hash within a batch are settled there, so
a passage that a third of all texts have costs one row per batch and not one per text.

Cases: a null text is empty; a text of fewer words than a window is never cut. A null id is
smaller than all others. Rows that repeat an id are one document: a window is earlier only if
it starts further up, and what goes from one of them goes from all. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setwise.llm.common import store, whole
from setwise.llm.words import Words, constants, mix, run_hashes, signed, small_batches, text_bytes

WINDOW = 20
SHINGLE = 8
LEAST_ID = -(1 << 63)
"""Stands for a null id while rows are compared."""

BLOCK, MARK, SPAN, CHECK = range(4)
"""Kinds of rows: a block to compare; news that an anchor is known; settled in the batch."""

_ROWS = "key long, other long, doc_id long, lo int, n int, kind byte"


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(LEAST_ID).to_numpy(zero_copy_only=False)


def window_starts(words: Words, window: int) -> np.ndarray:
    """Words at which a window begins that ends in the same text."""
    owner = np.repeat(np.arange(len(words)), words.counts())
    return np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :]) if len(owner) >= window else np.zeros(0, np.int64)


def blocks(words: Words, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor and hash of each block of a batch."""
    starts = window_starts(words, window)
    if not len(starts):
        none = np.zeros(0, dtype=np.uint64)
        return starts, starts, none, none
    hashes = words.windows(shingle, 1)
    best, place = hashes[starts], starts.copy()
    for i in range(1, window - shingle + 1):
        other = hashes[starts + i]
        less = other < best
        best = np.where(less, other, best)
        place = np.where(less, starts + i, place)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    lo, n = starts[first], np.diff(np.r_[first, len(starts)])
    return lo, n, best[first], run_hashes(words.hashes, lo, lo + n + window - 1, seed=2)


def _settle(key: np.ndarray, other: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order rows by hashes, id and place. Returns the order without repeated rows, which of
    these rows have an earlier equal in the batch, and the group of equal ``key`` of each."""
    order = np.lexsort((at, ids, other, key))
    k, o, d, p = key[order], other[order], ids[order], at[order]
    same_key = np.r_[False, k[1:] == k[:-1]]
    equal = same_key & np.r_[False, o[1:] == o[:-1]]
    repeated_row = equal & np.r_[False, (d[1:] == d[:-1]) & (p[1:] == p[:-1])]
    keep = ~repeated_row
    return order[keep], equal[keep], (np.cumsum(~same_key) - 1)[keep]


def _scattered(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys for rows that are settled, to spread them evenly."""
    return mix(ids.astype(np.uint64) * constants(1, 41)[0] + at.astype(np.uint64))


def _batch_rows(key, other, ids, lo, n, kind) -> pa.RecordBatch:
    direct = np.isin(kind, (SPAN, CHECK))
    key = np.where(direct, _scattered(ids, lo), key)
    return pa.record_batch(
        [
            signed(key), pa.array(other.view(np.int64), mask=kind != BLOCK), pa.array(ids),
            pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(kind.astype(np.int8)),
        ],
        ["key", "other", "doc_id", "lo", "n", "kind"],
    )


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        words = Words(batch.column("text"))
        lo, n, anchor, content = blocks(words)
        owner = np.searchsorted(words.first, lo, side="right") - 1
        ids, at = _ids(batch)[owner], lo - words.first[owner]
        order, later, group = _settle(anchor, content, ids, at)
        variants = np.bincount(group, weights=~later).astype(np.int64)
        known = variants[group] > 1 if len(group) else np.zeros(0, dtype=bool)
        kind = np.where(later, SPAN, np.where(known, CHECK, BLOCK))
        yield _batch_rows(anchor[order], content[order], ids[order], at[order], n[order], kind)
        told = np.unique(anchor[order][known & ~later])
        zero = np.zeros(len(told), dtype=np.int64)
        yield _batch_rows(told, told, zero, zero, zero, np.full(len(told), MARK))


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows to look up, by two hashes of their words."""
    for batch in small_batches(batches, "text"):
        words = Words(batch.column("text"))
        parts = batch.column("parts")
        owner = np.repeat(np.arange(batch.num_rows), np.asarray(parts.value_lengths().fill_null(0)))
        lo, n = (pa.compute.struct_field(parts.flatten(), i).to_numpy() for i in range(2))
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        owner, at = np.repeat(owner, n), at.astype(np.int64)
        inside = at + WINDOW <= words.counts()[owner]  # a row of the same id may be shorter
        owner, at = owner[inside], at[inside]
        first = words.first[owner] + at
        a = run_hashes(words.hashes, first, first + WINDOW, seed=3)
        b = run_hashes(words.hashes, first, first + WINDOW, seed=4)
        ids = _ids(batch)[owner]
        order, later, _ = _settle(a, b, ids, at)
        kind = np.where(later, SPAN, BLOCK)
        yield _batch_rows(a[order], b[order], ids[order], at[order], np.ones(len(order), dtype=np.int64), kind)


def _looked_up(rows: DataFrame) -> DataFrame:
    """Rows gathered by key, with ``later``: whether an equal one has a smaller id or place."""
    rows = rows.repartition("key").sortWithinPartitions("key", "other", "doc_id", "lo")
    equal = Window.partitionBy("key", "other").orderBy("doc_id", "lo")
    place = F.struct("doc_id", "lo")
    return rows.withColumn("later", (F.col("kind") == BLOCK) & (place > F.first(place).over(equal)))


def _parts(spans: DataFrame) -> DataFrame:
    """The spans of each text in one row; no longer than the text."""
    return spans.groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("lo", "n")).alias("parts"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of windows that occur earlier: ``doc_id``, first window ``lo``, windows ``n``."""
    rows = docs.select("doc_id", whole("text").alias("text"))
    found = _looked_up(rows.mapInArrow(_block_rows, _ROWS))
    everyone = Window.partitionBy("key")
    known = F.max(F.col("kind") == MARK).over(everyone) | (F.min("other").over(everyone) < F.max("other").over(everyone))
    found = found.withColumn("known", known)
    span = F.col("later") | (F.col("kind") == SPAN)
    check = (F.col("kind") == CHECK) | ((F.col("kind") == BLOCK) & F.coalesce("known", F.lit(False)))
    found = store(found.where(span | check).select("doc_id", "lo", "n", (~span).alias("check")), "factors")

    edges = _parts(found.where("check"))
    texts = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(LEAST_ID)))
    windows = texts.join(edges, F.col("doc_id") == F.col("of")).select("doc_id", "text", "parts")
    single = _looked_up(windows.mapInArrow(_window_rows, _ROWS)).where(F.col("later") | (F.col("kind") == SPAN))
    return found.where("NOT check").select("doc_id", "lo", "n").unionByName(store(single.select("doc_id", "lo", "n"), "edges"))


def _without_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        n_words, n_removed, kept = [], [], []
        for i, parts in enumerate(batch.column("parts").to_pylist()):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()  # splits at the same six bytes
            n_words.append(len(words))
            if parts:
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edges, [min(p["lo"], len(words)) for p in parts], 1)
                np.add.at(edges, [min(p["lo"] + p["n"] + WINDOW - 1, len(words)) for p in parts], -1)
                words = [words[j] for j in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8"))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "text"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: number of words, how many went, and the text that is left, its
    words joined by single spaces."""
    spans = _parts(repeated_spans(docs))
    rows = docs.select("doc_id", whole("text").alias("text"))
    joined = rows.join(spans, F.coalesce("doc_id", F.lit(LEAST_ID)) == F.col("of"), "left").select("doc_id", "text", "parts")
    return joined.mapInArrow(_without_parts, "doc_id long, n_words long, n_removed long, text string")
