"""Exact duplicates by two passes over a Bloom filter.

The first pass counts how many texts fall on each cell of a filter; a text can only have
a copy if all its cells were hit twice. The second pass probes the filter: rows that cannot
have a copy go straight through, and only the others are shuffled to be compared.

The filter has 16 cells a text and at most ``MAX_CELLS``, packed 64 to a row, so the table
that is broadcast has at most ``MAX_CELLS / 64`` rows. More texts than these serve are dealt
into slices by a hash of the text: equal texts are in one slice, each slice has a filter of its
own, and slices are worked through one after the other. So the filter tells as well for any
number of texts.

Cases: a null text equals an empty one. Of equal texts the row with the largest id stays; a
null id counts as the smallest. Rows that repeat both text and id count in the group, and
exactly one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import packed, store, unpacked, whole
from setwise.session import work_dir

CELLS_PER_TEXT = 16
PROBES = 2
MAX_CELLS = 1 << 26
"""2**26 cells are at most 2**20 packed rows of 16 bytes, the bound of the broadcast."""


def text_digest(text: str | Column = "text") -> Column:
    return F.sha2(whole(text), 256)


def cell_count(n_texts: int, per_text: int = CELLS_PER_TEXT, most: int = MAX_CELLS) -> int:
    wanted = max(64, n_texts * per_text)
    return min(most, 1 << (wanted - 1).bit_length())


def _cells(digest: Column, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(cells)) for i in range(PROBES)]


def repeated_cells(digests: DataFrame, cells: int) -> DataFrame:
    """Cells hit at least twice, packed: ``word`` and the ``bits`` set in it. Counts are
    combined before the shuffle, so a text with very many copies costs one row per task."""
    hit = digests.select(F.explode(F.array(*_cells(F.col("digest"), cells))).alias("cell"))
    twice = hit.groupBy("cell").count().where("count > 1")
    bit = F.expr("shiftleft(1L, cast(cell % 64 as int))")
    return twice.groupBy(F.expr("cell div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))


def hit_cells(digests: DataFrame, cells: int) -> DataFrame:
    """Cells hit at all, packed in the same way."""
    hit = digests.select(F.explode(F.array(*_cells(F.col("digest"), cells))).alias("cell"))
    bit = F.expr("shiftleft(1L, cast(cell % 64 as int))")
    return hit.groupBy(F.expr("cell div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))


def with_suspicion(df: DataFrame, bloom: DataFrame, cells: int) -> DataFrame:
    """Add ``suspect``: whether the text may occur twice. No row is shuffled."""
    bounded = F.broadcast(bloom)
    hits = []
    for i, cell in enumerate(_cells(F.col("digest"), cells)):
        probe = bounded.select(F.col("word").alias(f"word_{i}"), F.col("bits").alias(f"bits_{i}"))
        df = df.withColumn(f"cell_{i}", cell)
        df = df.join(probe, F.expr(f"cell_{i} div 64") == F.col(f"word_{i}"), "left")
        hits.append(F.coalesce(F.expr(f"getbit(bits_{i}, cast(cell_{i} % 64 as int)) = 1"), F.lit(False)))
    suspect = hits[0]
    for hit in hits[1:]:
        suspect = suspect & hit
    extra = [f"{n}_{i}" for i in range(PROBES) for n in ("cell", "word", "bits")]
    return df.withColumn("suspect", suspect).drop(*extra)


def _bloom(digests: DataFrame, n: int, max_cells: int) -> tuple[DataFrame, int]:
    cells = cell_count(n, most=max_cells)
    return store(repeated_cells(digests, cells), "bloom"), cells


Work = Callable[[DataFrame], DataFrame]
"""From rows that carry ``suspect`` to the result for them."""


def _by_slices(rows: DataFrame, n: int, max_cells: int, work: Work) -> DataFrame:
    """``work`` on ``rows`` (with a column ``digest``, ``n`` of them) once they carry
    ``suspect``. More rows than one filter serves are written by slice first, and the results
    of the slices are written as they come."""
    slices = max(1, -(-n * CELLS_PER_TEXT // max(64, max_cells)))
    if slices == 1:
        return work(with_suspicion(rows, *_bloom(rows.select("digest"), n, max_cells)))
    spark = rows.sparkSession
    dealt = store(rows.withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), "digest"), F.lit(slices))), "slices", "slice")
    path, schema = work_dir(spark, "sliced"), None
    for i in range(slices):
        own = dealt.where(F.col("slice") == i).drop("slice")
        done = work(with_suspicion(own, *_bloom(own.select("digest"), -(-n // slices), max_cells)))
        schema = done.schema
        done.write.parquet(f"{path}/{i}")
    return spark.read.schema(schema).parquet(*[f"{path}/{i}" for i in range(slices)])


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """Every row of ``docs`` with its group: key, ``keep_id``, ``group_size``, ``kept`` and
    the ``text_sha256``. The texts are read once."""
    digests = store(docs.select(F.col(key).alias("key"), text_digest(text).alias("digest")), "digests")
    found = _by_slices(digests, digests.count(), max_cells, _groups)
    return found.withColumnsRenamed({"key": key, "digest": "text_sha256"})


def _groups(flagged: DataFrame) -> DataFrame:
    alone = flagged.where("NOT suspect").select(
        "key", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    # A row per text and id first: repeated rows become a count, before anything is joined.
    rows = flagged.where("suspect").groupBy("digest", "key").agg(F.count(F.lit(1)).alias("times"))
    rows = store(rows, "suspects")
    # Stored, so that the join below has a plain table on either side: a text with very many
    # copies is then split over tasks.
    groups = rows.groupBy("digest").agg(F.max("key").alias("keep_id"), F.sum("times").alias("group_size"))
    groups = store(groups, "groups")
    compared = rows.join(groups, "digest").withColumn("nth", F.explode(F.expr("sequence(1L, times)")))
    kept = F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return alone.unionByName(compared.select("key", "keep_id", "group_size", kept.alias("kept"), "digest"))


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", max_cells: int = MAX_CELLS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows whose text cannot occur
    twice are not shuffled."""
    rows = packed(docs, key=docs[key], digest=text_digest(docs[text]))
    return unpacked(_by_slices(rows, docs.count(), max_cells, _winners))


def _winners(flagged: DataFrame) -> DataFrame:
    suspects = flagged.where("suspect")
    best = suspects.groupBy("digest").agg(F.max("key").alias("keep_id")).withColumnRenamed("digest", "same")
    winners = suspects.join(best, (F.col("digest") == F.col("same")) & F.col("key").eqNullSafe(F.col("keep_id")))
    winners = winners.select("row", "digest").dropDuplicates(["digest"])
    return flagged.where("NOT suspect").select("row").unionByName(winners.select("row"))
