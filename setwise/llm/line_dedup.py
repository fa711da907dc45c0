"""Repeated lines by pairwise alignment.

1. Lines that are not blank are hashed, and so is every shortest run of lines, from each line
   on and up to each line, that has ``LEAST_WORDS`` words. Documents with the same lines
   throughout are copies of the first of them, which alone goes on. A line or run that at
   most ``RARE`` documents have makes each earlier holder a partner of each later one. Of a
   commoner run, or line of as many words, the first two holders are partners of the others,
   and of a commoner short line together with the line after it.
2. Each document is aligned with its partners by patience diff: lines that occur once on both
   sides are matched in the longest common order, matches are extended to equal neighbours,
   and the gaps between are aligned in the same way. A gap without such lines is split at its
   common run of most words, as long as that is a block to delete. Each line is matched
   once: of a passage that the later document repeats, as many copies go as the earlier has.
3. Aligned blocks of at least ``LEAST_WORDS`` words are deleted from the later document, with
   the blank lines that follow them. Documents are aligned as they were, not as others left
   them.

Lines are equal if they are the same without white space at both ends. Earlier means a
smaller id.

Cases: null or empty text has no lines. A null id is smaller than all others. Rows that repeat
both id and text are one document, and never lose lines to each other; rows that repeat only
the id are documents in the order of a hash of their text. An empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import store, whole
from setwise.llm.words import (
    constants, hash_ranges, mix, run_hashes, signed, small_batches, sums_by_text, text_bytes, word_ranges,
)

RARE = 8
"""Holders of a line up to which all earlier ones are partners of a later one."""
LEAST_WORDS = 20
LEAST_ID = -(1 << 63)

def document() -> Column:
    """Documents in their order."""
    return F.struct("doc_id", "tie")


Block = tuple[int, int, int]
"""Where a common block begins on the left and on the right, and its number of lines."""


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order on the left, that is also in order on the right."""
    ends: list[int] = []
    at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, right) in enumerate(pairs):
        k = bisect_left(ends, right)
        ends[k : k + 1] = [right]
        at[k : k + 1] = [i]
        back[i] = at[k - 1] if k else -1
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int], in_gap: Callable[[list[int], list[int]], Block | None] | None = None) -> list[Block]:
    """Common blocks of two sequences of lines, in order on both sides. ``in_gap`` may tell a
    block of a gap where no line is unique on both sides."""
    matches: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matches.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matches.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {line: j for j, line in enumerate(b[b0:b1], b0) if in_b[line] == 1}
        unique = [(i, place[line]) for i, line in enumerate(a[a0:a1], a0) if in_a[line] == 1 and line in place]
        anchors = _increasing(unique)
        if anchors:
            # The gaps: what lies before, between and after the anchors, with each anchor at
            # the begin of the gap that follows it.
            cuts = [(a0, b0), *anchors, (a1, b1)]
            todo += [(i, p, j, q) for (i, j), (p, q) in zip(cuts, cuts[1:])]
        elif in_gap and not in_a.keys().isdisjoint(in_b):
            block = in_gap(a[a0:a1], b[b0:b1])
            if block:
                i, j, n = a0 + block[0], b0 + block[1], block[2]
                matches += [(i + k, j + k) for k in range(n)]
                todo += [(a0, i, b0, j), (i + n, a1, j + n, b1)]
    blocks: list[Block] = []
    for i, j in sorted(matches):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1] = (*blocks[-1][:2], blocks[-1][2] + 1)
        else:
            blocks.append((i, j, 1))
    return blocks


def shortest_runs(words: np.ndarray, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the shortest runs from each line on with so many words."""
    before = np.r_[0, np.cumsum(words, dtype=np.int64)]
    ends = np.searchsorted(before, before[:-1] + max(1, least_words))
    starts = np.flatnonzero(ends < len(before))
    return starts, ends[starts]


def aligned(a: list[int], b: list[int], words: list[int], least_words: int) -> list[Block]:
    """Common blocks by patience diff, and by the common run of most words in gaps without
    anchors. ``words``: word counts of the lines of ``b``."""
    size = dict(zip(b, words))

    def arrays(lines: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return np.array(lines, dtype=np.int64).view(np.uint64), np.array([size.get(x, 1) for x in lines], dtype=np.int64)

    def longest_run(left: list[int], right: list[int]) -> Block | None:
        (x, in_x), (y, in_y) = arrays(left), arrays(right)

        def common(least: int) -> Block | None:
            """The first on the right of the common runs with so many words."""
            (s, e), (p, q) = shortest_runs(in_x, least), shortest_runs(in_y, least)
            both, i, j = np.intersect1d(run_hashes(x, s, e, 1), run_hashes(y, p, q, 1), return_indices=True)
            if not len(both):
                return None
            k = int(np.argmin(j))
            return int(s[i[k]]), int(p[j[k]]), int(e[i[k]] - s[i[k]])

        low, high = max(1, least_words), int(min(in_x.sum(), in_y.sum())) + 1
        found = common(low)
        while found and high - low > 1:
            middle = (low + high) // 2
            more = common(middle)
            found, low, high = (more, middle, high) if more else (found, low, middle)
        return found

    return patience(a, b, longest_run)


def _hash_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and word counts of all lines that are not blank, and where those of each text
    begin and end. A line goes from its first word to its last."""
    data, offsets = text_bytes(texts)
    starts, ends = word_ranges(data, offsets)
    line = np.searchsorted(np.sort(np.r_[np.flatnonzero(data == 10), offsets[1:-1]], kind="stable"), starts, side="right")
    # A text ends its last line, so words of two texts never share one.
    fresh = np.flatnonzero(np.r_[True, line[1:] != line[:-1]][: len(line)])
    last = np.r_[fresh[1:], len(line)][: len(fresh)]
    hashes = hash_ranges(data, starts[fresh], ends[last - 1]) if len(fresh) else np.zeros(0, np.uint64)
    return hashes, (last - fresh).astype(np.int32), np.searchsorted(starts[fresh], offsets)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        hashes, counts, first = _hash_lines(batch.column("text"))
        lines, words = (pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), v) for v in (signed(hashes), pa.array(counts)))
        # A hash of all lines in order: documents with equal ones are copies.
        copy = run_hashes(hashes, first[:-1], first[1:], 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tie"), lines, words, signed(copy), pa.array(sums_by_text(counts, first))],
            ["doc_id", "tie", "lines", "words", "copy", "n_words"],
        )


def _run_keys(lines: np.ndarray, words: np.ndarray, least_words: int) -> np.ndarray:
    """Hashes of the runs of two or more lines that are shortest from their first line on or
    up to their last one."""
    starts, ends = shortest_runs(words, least_words)
    back_ends, back_starts = (len(words) - x for x in shortest_runs(words[::-1], least_words))
    starts, ends = np.r_[starts, back_starts], np.r_[ends, back_ends]
    several = ends - starts > 1
    return np.unique(run_hashes(lines, starts[several], ends[several], 1))


def _line_rows(least_words: int):
    """The different lines of each document, the hash of each with the line after it, and
    whether it is long enough to be a block alone; runs that are long enough count as lines,
    with nothing after them."""
    factor = constants(1, 61)[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), batch.column("lines"), batch.column("words")]
            for doc, tie, lines, words in zip(*columns):
                own = lines.values.to_numpy().view(np.uint64) if lines.is_valid and len(lines) else np.zeros(0, np.uint64)
                if not len(own):
                    continue
                pair = mix(own * factor + np.r_[own[1:], np.zeros(1, np.uint64)])
                both, at = np.unique(np.c_[own, pair], axis=0, return_index=True)
                runs = _run_keys(own, words.values.to_numpy(), least_words)
                n, yes = len(both) + len(runs), np.ones(len(runs), dtype=bool)
                fresh = np.r_[True, both[1:, 0] != both[:-1, 0], yes]
                long = np.r_[words.values.to_numpy()[at] >= least_words, yes]
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, doc)), pa.array(np.full(n, tie)), signed(np.r_[both[:, 0], runs]),
                        pa.array(np.r_[both[:, 1], runs].view(np.int64), mask=np.arange(n) >= len(both)),
                        pa.array(fresh), pa.array(long),
                    ],
                    ["doc_id", "tie", "line", "pair", "fresh", "long"],
                )

    return rows


def _holders(rows: DataFrame, key: str) -> DataFrame:
    """Number of holders of each key that several have, and the first of them. Counted before
    the shuffle."""
    held = rows.groupBy(F.col(key).alias("of")).agg(F.min(document()).alias("first"), F.count_if("fresh").alias("holders"))
    return store(held.where("holders > 1"), "holders")


def _with_first_two(held: DataFrame, key: str) -> DataFrame:
    """Pairs of later holders of a key with its first two. ``held``: rows with their key's
    first holder. The second one is the least of the others, so each is found by counting."""
    later = held.where(F.col("first") < document())
    second = later.groupBy(F.col(key).alias("of")).agg(F.min(document()).alias("second"))
    after = later.join(second, F.col(key) == F.col("of")).where(F.col("second") < document())
    pair = ("first", "doc_id", "tie")
    return later.select(*pair).union(after.select(F.col("second").alias("first"), "doc_id", "tie"))


def partners(rows: DataFrame, rare: int = RARE) -> tuple[DataFrame, DataFrame]:
    """Pairs of a document and an earlier one to align it with, and the lines of each document
    that another one has too."""
    held = _holders(rows, "line")
    found = store(rows.join(held, F.col("line") == F.col("of")).drop("of"), "shared_lines")
    few = found.where(F.col("fresh") & (F.col("holders") <= rare)).groupBy("line").agg(F.sort_array(F.collect_set(document())).alias("all"))
    few = few.select(F.posexplode("all").alias("at", "own"), "all").select(F.explode(F.slice("all", F.lit(1), F.col("at"))).alias("first"), "own.*")
    many = found.where(F.col("holders") > rare)
    common = store(many.where("pair IS NOT NULL").drop("first", "holders").withColumn("fresh", F.lit(True)), "common_lines")
    by_pair = common.join(_holders(common, "pair"), F.col("pair") == F.col("of")).drop("of")
    pairs = few.unionByName(_with_first_two(many.where(F.col("fresh") & F.col("long")), "line")).unionByName(_with_first_two(by_pair, "pair"))
    return pairs.distinct(), found.where(F.col("fresh") & F.col("pair").isNotNull()).select("doc_id", "tie", "line")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences of the lines that others have too (``at``: their places). One line that
    nobody has stands for those left out between them, so that no lines become neighbours."""
    for batch in batches:
        ats, kept, words = [], [], []
        for i in range(batch.num_rows):
            own, size = (batch.column(c)[i].values.to_numpy() for c in ("lines", "words"))
            held = np.isin(own, batch.column("others")[i].values.to_numpy())
            show = held | np.r_[True, held[:-1]][: len(held)]  # the first line of each stretch left out stays
            ats.append(np.flatnonzero(show).astype(np.int32))
            kept.append(own[show])
            words.append(size[show])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("tie"), pa.array(ats, pa.list_(pa.int32())), pa.array(kept, pa.list_(pa.int64())),
                pa.array(words, pa.list_(pa.int32())),
            ],
            ["doc_id", "tie", "at", "lines", "words"],
        )


def _align(least_words: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ties, starts, sizes = [], [], [], []
            for i in range(batch.num_rows):  # one pair at a time
                doc, tie, left, right, words, place = (batch.column(c)[i].as_py() for c in ("doc_id", "tie", "left_lines", "lines", "words", "at"))
                for _, at, n in aligned(left, right, words, least_words):
                    if sum(words[at : at + n]) >= least_words:
                        docs.append(doc)
                        ties.append(tie)
                        starts.append(place[at])
                        sizes.append(n)
            yield pa.record_batch(
                [pa.array(docs, pa.int64()), pa.array(ties, pa.int64()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())],
                ["doc_id", "tie", "at", "n"],
            )

    return align


def repeated_blocks(docs: DataFrame, rare: int = RARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """Blocks to delete: ``doc_id``, the hash ``tie`` of the text, first line ``at`` and number
    of lines ``n``, counted over the lines that are not blank."""
    rows = docs.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("doc_id"), F.xxhash64(whole()).alias("tie"), whole().alias("text"))
    kinds = "doc_id long, tie long, lines array<long>, words array<int>, copy long, n_words long"
    sequences = store(rows.mapInArrow(_sequences, kinds).dropDuplicates(["doc_id", "tie"]), "sequences")
    firsts = sequences.groupBy("copy").agg(F.min(document()).alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = store(firsts.where("copies > 1").drop("copies").withColumnRenamed("copy", "of"), "copies")
    later = sequences.select("doc_id", "tie", "copy", "n_words", F.size("lines").alias("n")).join(firsts, F.col("copy") == F.col("of"))
    later = store(later.where(F.col("first") < document()).select("doc_id", "tie", "n", "n_words"), "later_copies")
    gone = later.where(F.col("n_words") >= max(1, least_words)).select("doc_id", "tie", F.lit(0).alias("at"), "n")
    alone = store(sequences.drop("copy", "n_words").join(later.select("doc_id", "tie"), ["doc_id", "tie"], "left_anti"), "alone")
    lines = store(alone.mapInArrow(_line_rows(least_words), "doc_id long, tie long, line long, pair long, fresh boolean, long boolean"), "lines")
    pairs, others = partners(lines, rare)
    pairs = store(pairs, "partners")
    others = others.groupBy("doc_id", "tie").agg(F.collect_list("line").alias("others"))
    kinds = "doc_id long, tie long, at array<int>, lines array<long>, words array<int>"
    shared = store(alone.join(others, ["doc_id", "tie"]).mapInArrow(_shared, kinds), "shared")
    left = shared.select(document().alias("first"), F.col("lines").alias("left_lines"))
    both = pairs.join(left, "first").join(shared, ["doc_id", "tie"])
    both = both.select("doc_id", "tie", "left_lines", "lines", "words", "at")
    return gone.unionByName(both.mapInArrow(_align(least_words), "doc_id long, tie long, at int, n int"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        n_lines, n_removed, kept = [], [], []
        for i, blocks in enumerate(batch.column("blocks").to_pylist()):
            lines = data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
            gone = {j for b in blocks or () for j in range(b["at"], b["at"] + b["n"])}
            left, at = [], -1
            for line in lines:
                at += bool(line.strip())
                if at not in gone:  # a blank line goes with the line before it
                    left.append(line)
            n_lines.append(at + 1)
            n_removed.append(len(gone))
            kept.append(b"\n".join(left).decode("utf-8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_lines", "n_removed", "text"],
        )


def without_repeated_lines(docs: DataFrame, rare: int = RARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per row of ``docs``: its lines that are not blank, how many went, and the text left."""
    blocks = repeated_blocks(docs, rare, least_words)
    blocks = blocks.groupBy(F.col("doc_id").alias("of"), F.col("tie").alias("of_tie")).agg(
        F.collect_set(F.struct("at", "n")).alias("blocks")
    )
    rows = docs.select("doc_id", whole().alias("text"), F.xxhash64(whole()).alias("tie"))
    same = (F.coalesce("doc_id", F.lit(LEAST_ID)) == F.col("of")) & (F.col("tie") == F.col("of_tie"))
    joined = rows.join(blocks, same, "left").select("doc_id", "text", "blocks")
    return joined.mapInArrow(_cut, "doc_id long, n_lines long, n_removed long, text string")
