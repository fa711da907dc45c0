"""Similarity join of documents on word n-grams with adaptive multi-match prefixes.

A document is the set of its distinct shingles of five words. Two documents link if the
Jaccard similarity of their sets is at least ``PERCENT``; the result is exact.

The idea: sort every set by one order. If two sets overlap in at least T elements, the first
``size - T + m`` elements of both share at least m. The longer the prefix, the more it must
share, and the fewer documents do.

1. Every document shows a prefix with m = 5 % of its size, in order of hash. A document whose
   prefix shares fewer than m elements with documents of fitting size links with nothing.
   Most documents end here, and the rest, which have candidates, are lengthened.
2. These show their whole sets, and must share as much as a link needs. Now it is known how
   many documents have each element, and the order changes to the rarest first.
3. Elements that a document shares with the smallest holder give exact lower bounds of their
   overlap; pairs that pass by that are linked, which joins most groups of copies.
4. The others show a prefix of their rarest elements. Its length depends on the estimated
   number of candidates, the sum of the counts of its elements: above ``CHEAP`` the prefix
   grows, and with it the matches that a candidate must have. Candidates of different groups
   are verified on the whole sets. An element with more than ``CROWD`` holders makes no pairs
   of rows: its holders meet in blocks of ``BLOCK``, inside tasks, and only links come out.

Equal sets are one class from the start, and a batch shows each class once, so groups of
copies cost little however large they are.

Cases: null or empty text, or text without words, has an empty set and links with nothing.
Text of fewer words than a shingle has its whole word sequence as the only element. Rows that
repeat an id are members of the same groups. A null id counts for no component's name unless
there is no other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setwise.llm.common import packed, store, unpacked, whole
from setwise.llm.graph import components
from setwise.llm.words import Words, mix, run_hashes, signed, small_batches

SHINGLE = 5
PERCENT = 75
FIRST_MATCHES = 5
"""Matches that the first prefix asks for, in percent of the size."""
CHEAP = 200
"""Estimated candidates up to which a prefix of rare elements needs one match only."""
CROWD = 64
BLOCK = 1000
MAX_CELLS = 1 << 26
"""Cells of the filter that names the documents of step 2: 8 MB at most."""
CELLS_PER_CLASS = 16


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    words = Words(texts, lower=True)
    grams = words.windows(SHINGLE, 5)
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - begin >= SHINGLE:
            yield np.unique(grams[begin : end - SHINGLE + 1])
        elif end > begin:
            yield run_hashes(words.hashes[begin:end], np.array([0]), np.array([end - begin]), seed=6)
        else:
            yield np.zeros(0, dtype=np.uint64)


def class_of(tokens: np.ndarray) -> int:
    """A hash of a set: equal sets are one class."""
    return int(mix(np.array([mix(tokens).sum() + np.uint64(len(tokens))], dtype=np.uint64)).view(np.int64)[0])


# Sizes and roles. Of two linked sets, x is the smaller one (by size, then class) and y the
# larger one: the overlap is at least 3/7 of both sizes for 75 %, so 6/7 of x's.


def needed(n, sql: bool = False):
    """Overlap that a set of size n has with every set it links with."""
    return F.expr(f"({PERCENT} * n + 99) div 100") if sql else (PERCENT * n + 99) // 100


def needed_smaller(n, sql: bool = False):
    """The same for a link with a set that is not smaller."""
    part, whole = 2 * PERCENT, 100 + PERCENT
    return F.expr(f"({part} * n + {whole - 1}) div {whole}") if sql else (part * n + whole - 1) // whole


def first_matches(n: int) -> int:
    return max(1, min(needed(n), FIRST_MATCHES * n // 100))


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of the classes of a batch: token, class, size and whether the token is also
    in the shorter prefix of the role of the smaller set."""
    for batch in small_batches(batches, "text"):
        seen: set[int] = set()
        tokens, classes, sizes, lengths, small = [], [], [], [], []
        for own in shingle_sets(batch.column("text")):
            n = len(own)
            if not n or (name := class_of(own)) in seen:
                continue
            seen.add(name)
            m = first_matches(n)
            length = n - needed(n) + m
            tokens.append(own[:length])
            small.append(np.arange(length) < n - needed_smaller(n) + m)
            classes.append(name)
            sizes.append(n)
            lengths.append(length)
        if tokens:
            yield pa.record_batch(
                [
                    signed(np.concatenate(tokens)), pa.array(np.repeat(classes, lengths)),
                    pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)), pa.array(np.concatenate(small)),
                ],
                ["token", "cls", "n", "small"],
            )


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose token also occurs in a set of fitting size: ``above`` in one that is not
    smaller, ``below`` in one that is not larger and shows it in the role of the smaller."""
    order = Window.partitionBy("token").orderBy("n", "cls")
    rows = rows.repartition("token").sortWithinPartitions("token", "n", "cls")
    rows = rows.withColumn("again", F.lag("cls").over(order).eqNullSafe(F.col("cls"))).where("NOT again").drop("again")
    last = F.last(F.when(F.col("small"), F.col("n")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"next_n": F.lead("n").over(order), "last_n": last})
    above = F.coalesce(F.col("small") & (F.col("next_n") * PERCENT <= F.col("n") * 100), F.lit(False))
    below = F.coalesce(F.col("last_n") * 100 >= F.col("n") * PERCENT, F.lit(False))
    return rows.withColumns({"above": above, "below": below}).drop("next_n", "last_n").where("above OR below")


def _candidates(first: DataFrame) -> DataFrame:
    """Classes whose first prefix shares enough."""
    counts = _shared(first).groupBy("cls", "n").agg(F.count_if("above").alias("above"), F.count_if("below").alias("below"))
    matches = f"greatest(1, least(({PERCENT} * n + 99) div 100, {FIRST_MATCHES} * n div 100))"
    least = f"greatest(1, {FIRST_MATCHES} * (({PERCENT} * n + 99) div 100) div 100)"
    return counts.where(F.expr(f"above >= {matches} OR below >= {least}")).select("cls")


class ClassFilter:
    """A Bloom filter of class names with a bounded number of cells, built in Spark. Names it
    passes by mistake only add rows that are dropped later."""

    PROBES = 2

    def __init__(self, classes: DataFrame, most: int = MAX_CELLS):
        wanted = max(64, classes.count() * CELLS_PER_CLASS)
        self.cells = min(most, 1 << (wanted - 1).bit_length())
        cells = [F.pmod(F.shiftrightunsigned("cls", 24 * i), F.lit(self.cells)) for i in range(self.PROBES)]
        hit = classes.select(F.explode(F.array(*cells)).alias("cell"))
        bits = F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits")
        found = hit.groupBy(F.expr("cell div 64").alias("word")).agg(bits).toArrow()
        self.words = np.zeros(self.cells // 64, dtype=np.int64)
        self.words[found["word"].to_numpy()] = found["bits"].to_numpy()

    def __contains__(self, name: int) -> bool:
        for i in range(self.PROBES):
            cell = ((name & ((1 << 64) - 1)) >> 24 * i) % self.cells
            if not int(self.words[cell // 64]) >> (cell % 64) & 1:
                return False
        return True


def _whole_rows(rows: DataFrame, names: ClassFilter) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            seen: set[int] = set()
            for own in shingle_sets(batch.column("text")):
                if not len(own) or (name := class_of(own)) in seen or name not in shared.value:
                    continue
                seen.add(name)
                n = np.full(len(own), len(own), dtype=np.int32)
                cls = np.full(len(own), name, dtype=np.int64)
                yield pa.record_batch([signed(own), pa.array(cls), pa.array(n), pa.array(np.ones(len(own), bool))], ["token", "cls", "n", "small"])

    return rows.mapInArrow(emit, "token long, cls long, n int, small boolean")


def _vectors(whole: DataFrame) -> DataFrame:
    """Per class that can link at all: the elements it shares, rarest first, how many sets
    have each (``counts``), the smallest holder of each (``hubs``), and the roles it can take."""
    everyone = Window.partitionBy("token")
    rows = _shared(whole).withColumns({"holders": F.count(F.lit(1)).over(everyone), "hub": F.min("cls").over(everyone)})
    found = rows.groupBy("cls", "n").agg(
        F.sort_array(F.collect_list(F.struct("holders", "token", "hub"))).alias("items"),
        F.count_if("above").alias("above"),
        F.count_if("below").alias("below"),
    )
    found = found.withColumns({"small": F.col("above") >= needed_smaller("n", sql=True), "large": F.col("below") >= needed("n", sql=True)})
    return found.where("small OR large").select(
        "cls", "n", "small", "large", F.col("items.token").alias("tokens"),
        F.col("items.holders").alias("counts"), F.col("items.hub").alias("hubs"),
    )


def similar(n_x, n_y, overlap) -> Column:
    return F.col(overlap) * 100 >= (F.col(n_x) + F.col(n_y) - F.col(overlap)) * PERCENT


def _hub_links(vectors: DataFrame) -> DataFrame:
    """Pairs of a class and a smallest holder that are similar by the elements counted."""
    counted = vectors.select("cls", "n", F.explode("hubs").alias("hub")).where("cls <> hub")
    counted = counted.groupBy("cls", "n", "hub").agg(F.count(F.lit(1)).alias("overlap"))
    sizes = vectors.select(F.col("cls").alias("hub"), F.col("n").alias("hub_n"))
    return counted.join(sizes, "hub").where(similar("n", "hub_n", "overlap")).select(F.col("cls").alias("a"), F.col("hub").alias("b"))


def _rare_rows(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """Prefixes of rare elements of all classes, with their length by estimated candidates.
    Elements that nobody shares come first in the order and need no rows."""
    base = F.expr(f"n - ({PERCENT} * n + 99) div 100 + 1 - (n - size(tokens))")
    cost = F.aggregate(F.slice("counts", 1, F.greatest(base, F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    m = F.when(cost > CHEAP, F.expr(f"greatest(1, {FIRST_MATCHES} * n div 100)")).otherwise(F.lit(1)).cast("int")
    rows = vectors.withColumn("m", m).join(groups, F.col("cls") == F.col("node"), "left")
    rows = rows.withColumns({"comp": F.coalesce("comp", "cls"), "unshared": F.expr("n - size(tokens)")})
    last = {"as_small": F.col("n") - needed_smaller("n", sql=True) + F.col("m"), "as_large": F.col("n") - needed("n", sql=True) + F.col("m")}
    rows = rows.withColumns(last)
    shown = F.slice("tokens", 1, F.greatest(F.col("as_large") - F.col("unshared"), F.lit(0)).cast("int"))
    rows = rows.select("cls", "n", "m", "comp", "small", "large", "as_small", "unshared", F.posexplode(shown).alias("pos", "token"))
    small = F.col("small") & (F.col("pos") + F.col("unshared") < F.col("as_small"))
    rows = rows.select("token", "cls", "n", "m", "comp", small.alias("small"), "large").where("small OR large")
    everyone = Window.partitionBy("token")
    crossed = F.min("comp").over(everyone) < F.max("comp").over(everyone)
    rows = rows.withColumns({"holders": F.count(F.lit(1)).over(everyone), "crossed": crossed})
    return rows.where("crossed").drop("crossed")


def _pair_links(rare: DataFrame, vectors: DataFrame) -> DataFrame:
    """Candidates from elements with few holders, verified on the whole sets."""
    few = rare.where(f"holders <= {CROWD}")
    x = few.where("small").select("token", *[F.col(c).alias(f"x_{c}") for c in ("cls", "n", "m", "comp")])
    y = few.where("large").select("token", *[F.col(c).alias(f"y_{c}") for c in ("cls", "n", "m", "comp")])
    pairs = x.join(y, "token").where("x_comp <> y_comp AND (x_n < y_n OR (x_n = y_n AND x_cls < y_cls))")
    pairs = pairs.where(f"y_n * {PERCENT} <= x_n * 100")
    pairs = pairs.groupBy("x_cls", "x_n", "x_m", "y_cls", "y_n", "y_m").agg(F.count(F.lit(1)).alias("matches"))
    pairs = store(pairs.where("matches >= least(x_m, y_m)").select("x_cls", "x_n", "y_cls", "y_n"), "pairs")
    own = vectors.select(F.col("cls").alias("x_cls"), F.col("tokens").alias("x_tokens"))
    other = vectors.select(F.col("cls").alias("y_cls"), F.col("tokens").alias("y_tokens"))
    both = pairs.join(own, "x_cls").join(other, "y_cls")
    both = both.withColumn("overlap", F.size(F.array_intersect("x_tokens", "y_tokens")))
    return both.where(similar("x_n", "y_n", "overlap")).select(F.col("x_cls").alias("a"), F.col("y_cls").alias("b"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, in slices of elements."""
    flat = np.concatenate([*left, *right])
    _, place = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(t) for t in [*left, *right]])
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(place.max()) + 1 if len(place) else 0, columns):
        use = (place >= at) & (place < at + columns)
        block = np.zeros((len(left) + len(right), columns), dtype=np.float32)
        block[owner[use], place[use] - at] = 1
        total += block[: len(left)] @ block[len(left) :].T
    return total.astype(np.int64)


def spanning_links(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links (left, right) that connect what ``linked`` connects, without cycles."""
    free_left, free_right = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool)
    out: list[tuple[int, int]] = []
    for root in np.flatnonzero(linked.any(axis=1)):
        todo = [root] if free_left[root] else []
        free_left[root] = False
        while todo:
            x = todo.pop()
            for y in np.flatnonzero(linked[x] & free_right):
                free_right[y] = False
                out.append((x, y))
                for z in np.flatnonzero(linked[:, y] & free_left):
                    free_left[z] = False
                    out.append((z, y))
                    todo.append(z)
    return out


def _block_links(pdf):
    """Links between the sets of two blocks, or inside one block."""
    import pandas as pd

    left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
    right = left if len(right) == 0 else right
    n_x, n_y = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    overlap = _overlaps(list(left["tokens"]), list(right["tokens"]))
    fits = (overlap * 100 >= (n_x + n_y - overlap) * PERCENT) & (left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :])
    links = spanning_links(fits)
    a, b = left["cls"].to_numpy(), right["cls"].to_numpy()
    return pd.DataFrame({"a": [a[i] for i, _ in links], "b": [b[j] for _, j in links]}, dtype="int64")


def _crowd_links(rare: DataFrame, vectors: DataFrame) -> DataFrame:
    """Links among the holders of an element that very many sets have. The holders are dealt
    to blocks, and every two blocks meet in a task of their own; elements with the same
    holders are looked at once."""
    many = rare.where(f"holders > {CROWD}")
    mark = F.xxhash64("cls", "small", "large")
    tokens = many.groupBy("token").agg(
        F.sum(F.pmod(mark, F.lit(1 << 40))).alias("sum"), F.bit_xor(mark).alias("xor"), F.max("holders").alias("holders")
    )
    chosen = tokens.groupBy("holders", "sum", "xor").agg(F.min("token").alias("token")).select("token")
    rows = many.join(chosen, "token").withColumn("blocks", F.expr(f"cast((holders + {BLOCK - 1}) div {BLOCK} as int)"))
    rows = rows.withColumn("own", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    meeting = {"i": F.least("own", "other"), "j": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}
    rows = rows.withColumns(meeting).select("token", "i", "j", "side", "cls", "comp")
    rows = rows.join(vectors.select("cls", "n", "tokens"), "cls")
    return rows.groupBy("token", "i", "j").applyInPandas(_block_links, "a long, b long")


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        sets = list(shingle_sets(batch.column("text")))
        sizes = [len(s) for s in sets]
        names = [class_of(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tie"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())],
            ["doc_id", "tie", "cls", "n"],
        )


def class_links(texts: DataFrame) -> DataFrame:
    """Links between classes of equal sets (``a``, ``b``) that connect all that is similar."""
    first = texts.mapInArrow(_first_rows, "token long, cls long, n int, small boolean")
    names = ClassFilter(store(_candidates(first), "candidates"))
    vectors = store(_vectors(_whole_rows(texts, names)), "vectors")
    hubs = store(_hub_links(vectors), "hub_links")
    rare = store(_rare_rows(vectors, components(hubs)), "rare")
    pairs = _pair_links(rare, vectors).unionByName(_crowd_links(rare, vectors))
    return hubs.unionByName(store(pairs, "pair_links"))


def _members(docs: DataFrame) -> DataFrame:
    """Per row its id, a hash of its text (``tie``), the size of its set, and its component
    (``comp``, null without words)."""
    rows = docs.select("doc_id", F.xxhash64(whole()).alias("tie"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    members = store(rows.mapInArrow(_classes, f"doc_id {kind}, tie long, cls long, n long"), "classes")
    groups = components(class_links(docs.select("text")))
    joined = members.join(groups, F.col("cls") == F.col("node"), "left")
    return joined.select("doc_id", "tie", "n", F.coalesce("comp", "cls").alias("comp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id
    that links lead to."""
    joined = _members(docs)
    smallest = store(joined.where("comp IS NOT NULL").groupBy(F.col("comp").alias("of")).agg(F.min("doc_id").alias("first")), "smallest")
    named = joined.join(smallest, F.col("comp") == F.col("of"), "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns, and the rows without words.

    The row with the smallest id stays (a null id counts as the largest), of rows with that
    id the one whose text has the smallest hash, and of rows with equal id and text any one.
    Ids do not tell rows apart: an id may repeat with texts of other components.
    """
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "tie")
    found = store(_members(docs).where("comp IS NOT NULL").select("comp", place.alias("place")), "members")
    firsts = store(found.groupBy(F.col("comp").alias("of")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")), "firsts")
    several = found.join(firsts.where("rows > 1"), F.col("comp") == F.col("of"))
    dropped = store(several.where(F.col("place") != F.col("first")).select("place").distinct(), "dropped")
    # Rows of one id and text that stay, if there are several: one of them is enough.
    again = several.where(F.col("place") == F.col("first")).groupBy("place").count().where("count > 1")
    again = store(again.select(F.col("place").alias("repeated")), "repeated")
    own = F.struct(docs["doc_id"].isNull().alias("nameless"), docs["doc_id"].alias("doc_id"), F.xxhash64(whole(docs["text"])).alias("tie"))
    rows = packed(docs, own=own).join(dropped, F.col("own").eqNullSafe(F.col("place")), "left_anti")
    if again.isEmpty():
        return unpacked(rows)
    marked = rows.join(again, F.col("own").eqNullSafe(F.col("repeated")), "left")
    one = marked.where("repeated IS NOT NULL").dropDuplicates(["own"])
    return unpacked(marked.where("repeated IS NULL").select("row").unionByName(one.select("row")))
