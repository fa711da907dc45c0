"""Mix sources to target weights by weighted random order (Efraimidis and Spirakis).

Every document draws an exponential key scaled by its quality weight; within a source the
documents are ordered by key. A source's budget is spent on complete epochs first, in which
each document is taken once; what is left goes to the documents of smallest key until the
running total of their sizes comes nearest to it.

No source is sorted in one task. Keys are counted in fixed buckets of their logarithm, a
running total over buckets finds the bucket in which the budget ends, and only the documents
of that bucket are put in order.

Cases: null text has size 0; null is a source of its own, last in order. A document without
a weight, or with one that is null or not positive, weighs 1. Sources without words have
target 0. Rows that repeat id, source and size are taken equally often. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setwise.llm.common import packed, store, unpacked, word_count

MAX_EPOCHS = 3
BUCKETS_PER_UNIT = 1024
"""Buckets of the natural logarithm of the key. One holds at most 0.04 percent of the
documents of a weight, whatever the weight is, as a weight only shifts the logarithms."""


def rotating_weights(sources: DataFrame, weights: Sequence[float] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Weights for a list of sources: in order by code point, null last, repeating.
    ``sources`` has one row per source, a list that a person could write down."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    return sources.select("source", pick.alias("weight"))


def source_targets(sizes: DataFrame, weights: DataFrame, budget: float | None = None, cap: float = MAX_EPOCHS) -> DataFrame:
    """Targets in proportion to weights that add up to ``budget`` (all sizes if not given).

    A target stops at ``cap`` times the size of its source and the excess is shared out again
    by weight until none is above. Sources fill up in the order of size per weight, so a
    running total over that order gives the result at once. ``sizes`` has a row per source.
    """
    weights = weights.withColumnRenamed("source", "weighed")
    rows = sizes.join(weights, F.col("source").eqNullSafe(F.col("weighed")), "left").select(
        "source", "source_size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("w")
    )
    limit = F.col("source_size") * F.lit(float(cap))
    fill = F.when(F.col("w") > 0, limit / F.col("w")).otherwise(F.lit(float("inf")))
    rows = rows.withColumns({"limit": limit, "fill": fill})
    everyone = Window.partitionBy()
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(everyone).cast("double") if budget is None else F.lit(float(budget))
    full_before = F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns(
        {
            "place": F.row_number().over(order),
            "left": F.greatest(total - F.coalesce(full_before, F.lit(0.0)), F.lit(0.0)),
            "sharing": F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    share = F.when(F.col("sharing") > 0, F.col("left") / F.col("sharing")).otherwise(F.lit(0.0))
    # The first source that its share does not fill sets the level for all that follow.
    first = F.min(F.when((F.col("w") > 0) & (share < F.col("fill")), F.struct("place", share.alias("level")))).over(everyone)
    level = F.coalesce(first["level"] * F.col("w"), F.col("limit"))
    target = F.when(F.col("w") > 0, F.least("limit", level)).otherwise(F.lit(0.0))
    return rows.select("source", "source_size", target.alias("target"))


def exponential_key(key: str | Column, weight: Column, seed: int) -> Column:
    """An exponential variable of rate ``weight``, fixed by the id and the seed."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12).cast("double")
    uniform = (draw + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.when(weight > 0, weight).otherwise(F.lit(1.0))


def mix_counts(
    sized: DataFrame, weights: DataFrame | None = None, budget: float | None = None, seed: int = 0, cap: float = MAX_EPOCHS
) -> DataFrame:
    """How often each document is taken.

    ``sized`` has key, source, size and weight. Returns one row for each key, source and
    size with ``source_size``, ``target`` (the source's), ``copies`` and the number ``times``
    of rows it stands for. Sums are combined before they are shuffled, so a source with most
    of the documents is no harder than the others.
    """
    units = sized.groupBy("key", "source", "size").agg(F.max("weight").alias("weight"), F.count(F.lit(1)).alias("times"))
    units = units.withColumn("draw", exponential_key("key", F.col("weight"), seed))
    units = units.withColumns({"bucket": F.floor(F.log("draw") * BUCKETS_PER_UNIT), "words": F.col("size") * F.col("times")})
    units = store(units.drop("weight"), "mix")
    buckets = store(units.groupBy("source", "bucket").agg(F.sum("words").alias("words")), "buckets")
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    weights = rotating_weights(sizes.select("source")) if weights is None else weights
    plan = source_targets(sizes, weights, budget, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = plan.withColumnRenamed("source", "of")

    # The running total over buckets shows where the rest of the budget ends.
    until = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    ends = buckets.withColumn("until", until).join(plan, F.col("source").eqNullSafe(F.col("of")))
    fits = F.col("until") <= F.col("rest")
    edge = ends.groupBy("of", "source_size", "target", "epochs", "rest").agg(
        F.coalesce(F.max(F.when(fits, F.col("until"))), F.lit(0)).alias("spent"),
        F.min(F.when(~fits, F.col("bucket"))).alias("edge"),
    )
    edge = store(edge, "edges")

    placed = units.join(edge, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    inside = F.col("edge").isNull() | (F.col("bucket") < F.col("edge"))
    clear = placed.where(F.col("edge").isNull() | (F.col("bucket") != F.col("edge")))
    clear = clear.withColumn("copies", F.col("epochs") + inside.cast("long"))
    order = Window.partitionBy("source").orderBy("draw", F.col("key").asc_nulls_first(), "size")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    so_far = F.coalesce(before, F.lit(0)) + F.col("spent")
    nearest = so_far * 2 + F.col("words") <= F.col("rest") * 2
    border = placed.where(F.col("bucket") == F.col("edge")).withColumn("copies", F.col("epochs") + nearest.cast("long"))
    return clear.unionByName(border).select("key", "source", "size", "times", "source_size", "target", "copies")


def quality_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """A weight per labelled document; contradicting labels average."""
    return labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.avg(F.when(F.col("quality") == 1, F.lit(good)).when(F.col("quality") == 0, F.lit(bad))).alias("weight")
    )


def _sized(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    sized = docs.select(F.col("doc_id").alias("key"), "source", word_count("text").alias("size"))
    if labels is None:
        return sized.withColumn("weight", F.lit(1.0))
    weights = quality_weights(labels)
    joined = sized.join(weights, F.col("key") == F.col("labelled"), "left")
    return joined.select("key", "source", "size", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def mix(docs: DataFrame, labels: DataFrame | None = None, **options) -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes."""
    counted = mix_counts(_sized(docs, labels), **options)
    rows = counted.withColumn("nth", F.explode(F.expr("sequence(1L, times)")))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", taken, "source", "copies")


def mixed_documents(docs: DataFrame, labels: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = packed(docs, key=docs["doc_id"], source=docs["source"], size=word_count(docs["text"]))
    same = ("key", "source", "size")
    counts = mix_counts(_sized(docs, labels), **options).where("copies > 0")
    counts = counts.select(*[F.col(c).alias(f"of_{c}") for c in same], "copies")
    taken = rows.join(counts, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in same])
    return unpacked(taken.withColumn("nth", F.explode(F.expr("sequence(1L, copies)"))))
