"""Joins, splits and small reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setwise.operators.ordered import MAX_ROWS, Axis, cumulate, fit_axis, ordered


def restrict_to_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``.

    No broadcast is forced: Spark broadcasts the keys if their measured size allows it
    and otherwise shuffles, where adaptive execution splits a heavy key.
    """
    return df.join(keys.select(*on), list(on), "left_semi")


def left_join_on_keys(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other, list(on), "left")


def key_bucket(key: Column | str, seed: int, buckets: int = 100) -> Column:
    """A bucket that depends on the key and the seed only, not on the row order."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string") if isinstance(key, str) else key))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_by_key(df: DataFrame, key: str, percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Split by whole keys. Row-local: needs no list of keys and no join."""
    bucket = key_bucket(key, seed)
    return df.where(bucket < percent), df.where(bucket >= percent)


@ordered
def hold_last(df: DataFrame, axis: Axis, **values: Column) -> DataFrame:
    """For each output, the latest non-null value up to and including the row."""
    return cumulate(df, axis, last=values)


def fit_both(
    left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = (), max_rows: int = MAX_ROWS
) -> Axis:
    """An axis that suits the rows of both sides together, as they are scanned together: a
    session may be heavy on either side, or only with both."""
    narrow = [side.select(*keys, time) for side in (left, right)]
    return replace(fit_axis(narrow[0].unionAll(narrow[1]), tuple(keys), time, max_rows=max_rows), ties=tuple(ties))


def align_hold_last(
    left: DataFrame, right: DataFrame, axis: Axis, columns: Sequence[str], stamp: str | None = None
) -> DataFrame:
    """Give each row of ``left`` the ``columns`` of the latest ``right`` row of its
    session that is not later (rows of ``right`` come first at equal times).

    A union and one ordered scan: the inputs are shuffled once and no pair of rows is
    formed. ``stamp`` adds the time of the right row.
    """
    side = Axis(axis.keys, axis.time, ("__side", *axis.ties), axis.chunk)
    packet = F.struct(F.col(axis.time).alias("__time"), *columns)
    rights = right.select(*axis.keys, axis.time, packet.alias("__packet")).withColumn("__side", F.lit(0))
    lefts = left.withColumn("__side", F.lit(1))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    held = hold_last(both, side, __held=F.col("__packet")).where("__side = 1")
    taken = [F.col(f"__held.{c}").alias(c) for c in columns]
    if stamp:
        taken.append(F.col("__held.__time").alias(stamp))
    return held.select(*left.columns, *taken)


def latest(df: DataFrame, by: str, n: int = 1, ties: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows; among equally new ones those largest in ``ties``. Each
    partition keeps its own top ``n`` before the merge."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in (by, *ties)]).limit(n)


def confusion_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and weighted F1: one row, or one for
    each value of ``by``.

    One aggregation over the rows; the rest works on the (class, class) counts.
    """
    pairs = [F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")]
    counts = df.groupBy(*by, *pairs).agg(F.count(F.lit(1)).alias("n"))
    # Each count is a row of its label and a column of its prediction.
    sides = counts.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col("l").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("called")),
                F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("called")),
            )
        ).alias("s"),
        F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
    ).select(*by, "s.*", F.when(F.col("s.actual") > 0, F.col("hit")).otherwise(0).alias("hits"))
    classes = sides.groupBy(*by, "c").agg(F.sum("actual").alias("a"), F.sum("called").alias("b"), F.sum("hits").alias("h"))
    precision = F.coalesce(F.try_divide("h", "b"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("h", "a"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("a")
    return classes.groupBy(*by).agg(
        (F.sum("h") / total).alias("accuracy"),
        (F.sum(F.col("a") * precision) / total).alias("weighted_precision"),
        (F.sum(F.col("a") * recall) / total).alias("weighted_recall"),
        (F.sum(F.col("a") * f1) / total).alias("f1"),
    )
