"""Ranked search: the best documents for each item by MaxScore with bounds of term pairs.

1. Documents are cut into shards of some megabytes, in place. A shard's index holds, for each
   term that an item asks for, the documents that have it and how often. Counts over all
   shards give the weights of the terms and the numbers of documents and terms.
2. With these, postings become impacts: what a term adds to a document's score. An item's
   terms stand in falling order of weight, and for every two neighbours a shard stores the
   largest joint impact in the intersection of their lists. The best joint impacts by item,
   of different documents, give each search a score to start from that its results reach.
3. A search goes through a shard's lists in that order. What the terms from some place on
   can add at most is the least of all ways to take them one by one or as neighbouring
   pairs; a pair adds no more than its joint impact or the larger of the two alone. Once
   that is too little for the score to reach, only documents seen so far are looked up in
   the other lists, and fewer of them with every list. Shards whose bound is too small are
   skipped. Tasks keep the best of their shards, and these are ranked over all tasks.

Bounds only skip what cannot be among the best, so results are exact. Terms are told apart by
64-bit hashes. Items are searched in blocks of at most about ``MAX_TERMS`` terms, a pass over
the documents for each, which bounds what the tasks are sent.

Cases: null or empty texts have no terms; such items find nothing and such documents are not
found. Each row of either table counts by itself, also if its id repeats or is null; a null
document id comes last among equal scores. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setwise.llm.common import store
from setwise.llm.words import hash_ranges, small_batches, text_bytes, word_ranges

TOP = 10
SHARD_BYTES = 8 << 20
MAX_TERMS = 1 << 20
SLOTS = 64
"""Groups of tasks that are ranked by themselves first."""
NO_ID = (1 << 63) - 1
"""Stands for a null id inside tasks: the last one."""


def _outside_terms() -> np.ndarray:
    """Bytes that part terms: all of ASCII but digits and letters."""
    table = np.zeros(256, dtype=bool)
    table[:0x80] = True
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        table[a:b] = False
    return table


_OUTSIDE = _outside_terms()


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and where the terms of each text begin and end."""
    data, offsets = text_bytes(texts)
    starts, ends = word_ranges(data, offsets, _OUTSIDE)
    return hash_ranges(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Per item row its id and its different terms."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes, first = terms_of(batch.column("text"))
            lists = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([batch.column("item"), pa.array(lists, pa.list_(pa.int64()))], ["item", "terms"])

    rows = items.select(items[key].alias("item"), items[text].alias("text"))
    return rows.mapInArrow(take, f"item {dict(rows.dtypes)['item']}, terms array<long>").where("size(terms) > 0")


@dataclass
class Search:
    """The items of one block. Terms are numbers: places in ``names``. ``pairs`` are two terms
    that are neighbours in some item; ``links[q]`` has the number of each pair of item q."""

    names: np.ndarray
    items: list[np.ndarray]
    weights: np.ndarray | None = None
    pairs: np.ndarray | None = None
    links: list[np.ndarray] | None = None
    floors: np.ndarray | None = None

    @staticmethod
    def of(lists: list[list[int]]) -> Search:
        arrays = [np.array(terms, dtype=np.int64).view(np.uint64) for terms in lists]
        names = np.unique(np.concatenate(arrays))
        return Search(names, [np.searchsorted(names, terms) for terms in arrays])

    def weigh(self, n_docs: int, holders: np.ndarray) -> None:
        """Set the weights and the order of terms, which decides the pairs."""
        ratio = [(2 * n_docs + 2) / (2 * int(df) + 1) for df in holders]
        self.weights = np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)
        self.items = [terms[np.lexsort((terms, -self.weights[terms]))] for terms in self.items]
        n = len(self.names)
        codes = [np.minimum(t[:-1], t[1:]) * n + np.maximum(t[:-1], t[1:]) for t in self.items]
        every = np.unique(np.concatenate(codes))
        self.pairs = np.stack([every // n, every % n], axis=1)
        self.links = [np.searchsorted(every, c) for c in codes]


INDEX = "docs array<long>, sizes binary, n_docs long, n_terms long, terms binary, ends binary, places binary, times binary"


def index(docs: DataFrame, key: str, text: str, search: Search) -> DataFrame:
    """A row per shard: its documents with a term asked for, and the postings by term."""
    names = docs.sparkSession.sparkContext.broadcast(search.names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SHARD_BYTES):
            hashes, first = terms_of(batch.column("text"))
            sizes = np.diff(first)
            n = len(sizes)
            term = np.searchsorted(names.value, hashes)
            hit = names.value[np.minimum(term, len(names.value) - 1)] == hashes
            code, times = np.unique(term[hit] * n + np.repeat(np.arange(n), sizes)[hit], return_counts=True)
            term, place = code // n, code % n
            held, place = np.unique(place, return_inverse=True)
            terms, starts = np.unique(term, return_index=True)
            columns = [
                sizes[held].astype(np.int64), terms.astype(np.int32), np.r_[starts, len(term)][1:].astype(np.int64),
                place.astype(np.int32), times.astype(np.int64),
            ]
            sizes_, terms_, ends_, places_, times_ = [pa.array([c.tobytes()], pa.binary()) for c in columns]
            ids = batch.column("id").fill_null(NO_ID).take(pa.array(held))
            ids = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), ids)
            yield pa.record_batch(
                [ids, sizes_, pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())]), terms_, ends_, places_, times_],
                ["docs", "sizes", "n_docs", "n_terms", "terms", "ends", "places", "times"],
            )

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    return store(rows.mapInArrow(build, INDEX), "index")


def _numbers(row: dict, name: str, kind=np.int64) -> np.ndarray:
    return np.frombuffer(row[name], dtype=kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The shards of a task one by one: ids as an array, the rest as they are."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            yield {c: v.values.to_numpy() if c == "docs" else v.as_buffer() if pa.types.is_binary(v.type) else v.as_py() for c, v in row.items()}


def holders(shards: DataFrame, n_names: int) -> np.ndarray:
    """In how many documents each term is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_names, dtype=np.int64)
        for row in _rows(batches):
            total[_numbers(row, "terms", np.int32)] += np.diff(_numbers(row, "ends"), prepend=0)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    counts = shards.select("terms", "ends").mapInArrow(count, "term long, n long")
    found = counts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term asked for
    out = np.zeros(n_names, dtype=np.int64)
    out[found["term"].to_numpy()] = found["n"].to_numpy()
    return out


def shortness(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length factor of documents of these sizes."""
    if sizes.size and 90 * int(sizes.max()) * n_docs >= 1 << 63:
        return 10 + ((90 * sizes.astype(object) * n_docs) // n_terms).astype(np.int64)
    return 10 + (90 * sizes * n_docs) // n_terms


def best_by_document(docs: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(n, dtype=np.int64)
    np.maximum.at(total, docs, scores)
    held = np.flatnonzero(total)
    return held, total[held]


IMPACTS = (
    "docs array<long>, terms binary, ends binary, places binary, impacts binary, most binary, joint_pairs binary, joint binary, "
    "floor_items binary, floors binary"
)


def impacts(shards: DataFrame, search: Search, n_docs: int, n_terms: int) -> DataFrame:
    """Shards with impacts in place of counts, the largest by term and by pair, and the best
    joint impacts by item."""
    shared = shards.sparkSession.sparkContext.broadcast(search)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        for row in _rows(batches):
            terms, ends = _numbers(row, "terms", np.int32), _numbers(row, "ends")
            places, times = _numbers(row, "places", np.int32), _numbers(row, "times")
            m = shortness(_numbers(row, "sizes"), n_docs, n_terms)
            lengths = np.diff(ends, prepend=0)
            impact = np.repeat(search.weights[terms], lengths) * ((1_000_000_000 * times) // (1000 * times + 8 * m[places]))
            most = np.maximum.reduceat(impact, ends - lengths) if len(terms) else impact
            local = np.full(len(search.names), -1)
            local[terms] = np.arange(len(terms))
            both = local[search.pairs]
            near = np.flatnonzero((both >= 0).all(axis=1))
            joint = np.zeros(len(near), dtype=np.int64)
            lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for k, (p, (a, b)) in enumerate(zip(near.tolist(), both[near].tolist())):
                if lengths[a] > lengths[b]:
                    a, b = b, a
                x, y = slice(ends[a] - lengths[a], ends[a]), slice(ends[b] - lengths[b], ends[b])
                at = np.minimum(np.searchsorted(places[y], places[x]), lengths[b] - 1)
                same = places[y][at] == places[x]
                if same.any():
                    lists[p] = places[x][same], impact[x][same] + impact[y][at[same]]
                    joint[k] = lists[p][1].max()
            floor_items, floors = [], []
            for q, links in enumerate(search.links):
                found = [lists[p] for p in links.tolist() if p in lists]
                if found:
                    _, scores = best_by_document(*map(np.concatenate, zip(*found)), len(row["docs"]))
                    best = np.sort(scores)[::-1][:TOP]
                    floor_items.append(np.full(len(best), q, dtype=np.int64))
                    floors.append(best)
            more = [
                impact, most, near.astype(np.int64), joint,
                np.concatenate(floor_items or [np.zeros(0, np.int64)]), np.concatenate(floors or [np.zeros(0, np.int64)]),
            ]
            ids = pa.ListArray.from_arrays(pa.array([0, len(row["docs"])], pa.int32()), pa.array(row["docs"], pa.int64()))
            same = [pa.array([row[c].to_pybytes()], pa.binary()) for c in ("terms", "ends", "places")]
            added = [pa.array([c.astype(np.int64).tobytes()], pa.binary()) for c in more]
            names = ["docs", "terms", "ends", "places", "impacts", "most", "joint_pairs", "joint", "floor_items", "floors"]
            yield pa.record_batch([ids, *same, *added], names)

    return store(shards.mapInArrow(build, IMPACTS), "impacts")


def _top(rows: DataFrame, *order) -> DataFrame:
    """The first ``TOP`` rows of each item: within groups of tasks, then over all."""
    for by in (("item_row", "slot"), ("item_row",)):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("rank", place).where(F.col("rank") <= TOP)
    return rows


def _slot() -> int:
    return TaskContext.get().partitionId() % SLOTS


def starting_scores(lists: DataFrame, n_items: int) -> np.ndarray:
    """A score that the last of the best documents of each item has at least."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for row in _rows(batches):
            items, scores = _numbers(row, "floor_items"), _numbers(row, "floors")
            for q in np.unique(items).tolist():
                both = np.r_[kept.get(q, np.zeros(0, np.int64)), scores[items == q]]
                kept[q] = np.sort(both)[::-1][:TOP]
        for q, scores in kept.items():
            n = len(scores)
            yield pa.record_batch(
                [pa.array([q] * n, pa.int32()), pa.array([_slot()] * n, pa.int32()), pa.array(scores)], ["item_row", "slot", "score"]
            )

    rows = lists.select("floor_items", "floors").mapInArrow(best, "item_row int, slot int, score long")
    last = _top(rows, F.desc("score")).where(F.col("rank") == TOP).select("item_row", "score").toArrow()  # one row an item
    out = np.zeros(n_items, dtype=np.int64)
    out[last["item_row"].to_numpy()] = last["score"].to_numpy()
    return out


def suffix_bounds(most: np.ndarray, joint: np.ndarray) -> list[int]:
    """What the terms from each place on add at most: each alone, or with its neighbour."""
    out = [0] * (len(most) + 1)
    for i in range(len(most) - 1, -1, -1):
        out[i] = int(most[i]) + out[i + 1]
        if i + 1 < len(most):
            out[i] = min(out[i], max(int(most[i]), int(most[i + 1]), int(joint[i])) + out[i + 2])
    return out


class Best:
    """The best documents of one item so far."""

    def __init__(self, floor: int):
        self.floor = max(1, floor)
        self.ids, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.r_[self.ids, ids], np.r_[self.scores, scores]
        first = np.lexsort((ids, -scores))[:TOP]
        self.ids, self.scores = ids[first], scores[first]
        if len(first) == TOP:
            self.floor = max(self.floor, int(scores[first[-1]]))


class Shard:
    """Lists of one shard by term, and the bounds stored with them."""

    def __init__(self, row: dict, search: Search):
        self.ids = row["docs"]
        self.terms, self.ends = _numbers(row, "terms", np.int32), _numbers(row, "ends")
        self.places, self.impacts = _numbers(row, "places", np.int32), _numbers(row, "impacts")
        self.most = np.zeros(len(search.names), dtype=np.int64)
        self.most[self.terms] = _numbers(row, "most")
        self.local = np.full(len(search.names), -1)
        self.local[self.terms] = np.arange(len(self.terms))
        self.joint = np.zeros(len(search.pairs), dtype=np.int64)
        self.joint[_numbers(row, "joint_pairs")] = _numbers(row, "joint")

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        i = self.local[term]
        if i < 0:
            return self.places[:0], self.impacts[:0]
        own = slice(self.ends[i - 1] if i else 0, self.ends[i])
        return self.places[own], self.impacts[own]

    def search(self, terms: np.ndarray, links: np.ndarray, best: Best) -> None:
        bounds = suffix_bounds(self.most[terms], self.joint[links])
        if bounds[0] < best.floor:
            return
        total = np.zeros(len(self.ids), dtype=np.int64)
        at = 0
        while at < len(terms) and bounds[at] >= best.floor:
            places, impact = self.postings(terms[at])
            total[places] += impact
            at += 1
        found = np.flatnonzero((total > 0) & (total + bounds[at] >= best.floor))
        scores = total[found]
        while at < len(terms) and len(found):
            places, impact = self.postings(terms[at])
            at += 1
            if len(places):
                near = np.minimum(np.searchsorted(places, found), len(places) - 1)
                scores = scores + np.where(places[near] == found, impact[near], 0)
            left = scores + bounds[at] >= best.floor
            found, scores = found[left], scores[left]
        if len(found):
            best.add(self.ids[found], scores)


def _search_all(lists: DataFrame, search: Search) -> DataFrame:
    shared = lists.sparkSession.sparkContext.broadcast(search)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        best = [Best(int(floor)) for floor in search.floors]
        for row in _rows(batches):
            shard = Shard(row, search)
            for terms, links, own in zip(search.items, search.links, best):
                shard.search(terms, links, own)
        sizes = [len(b.ids) for b in best]
        ids = np.concatenate([b.ids for b in best])
        yield pa.record_batch(
            [
                pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)), pa.array(np.full(len(ids), _slot(), dtype=np.int32)),
                pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b.scores for b in best])),
            ],
            ["item_row", "slot", "doc_id", "score"],
        )

    rows = lists.drop("floor_items", "floors").mapInArrow(find, "item_row int, slot int, doc_id long, score long")
    return _top(rows, F.desc("score"), F.asc_nulls_last("doc_id"))


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    max_terms: int = MAX_TERMS,
) -> DataFrame:
    """Per row of ``items`` its ``TOP`` best documents with a score above 0: the item's id,
    ``rank``, ``doc_id`` and ``score``."""
    spark = docs.sparkSession
    asked = store(item_terms(items, item, item_text), "items")
    kind = dict(asked.dtypes)["item"]
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-n_terms // max_terms)
    parts = []
    for block in range(n_blocks):
        mine = asked.where(F.pmod(F.xxhash64("item", "terms"), F.lit(n_blocks)) == block).collect()
        if not mine:
            continue
        found = Search.of([r["terms"] for r in mine])
        shards = index(docs, key, text, found)
        counts = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not counts[1]:
            continue
        found.weigh(int(counts[0]), holders(shards, len(found.names)))
        lists = impacts(shards, found, int(counts[0]), int(counts[1]))
        found.floors = starting_scores(lists, len(mine))
        named = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(mine)], f"item_row int, item {kind}")
        best = _search_all(lists, found).join(F.broadcast(named), "item_row")  # max_terms rows at most
        parts.append(best.select(F.col("item").alias(item), "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"`{item}` {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
