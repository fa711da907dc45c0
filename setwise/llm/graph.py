"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setwise.llm.common import scratch, store


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the smallest node it is connected with, for the nodes of
    ``edges`` (columns ``a`` and ``b``).

    Every round takes the smallest label of the neighbours and then the label of the label,
    so chains shorten by half. Messages are combined before the shuffle: a node with very
    many neighbours costs one row per task.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b")
    both = store(both.distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        with scratch(edges.sparkSession):
            near = both.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("to")).agg(F.min("comp").alias("near"))
            moved = labels.join(near, F.col("node") == F.col("to"), "left").select(
                "node", F.col("comp").alias("was"), F.least("comp", F.coalesce("near", "comp")).alias("comp")
            )
            moved = store(moved, "moved")
            up = moved.select(F.col("node").alias("over"), F.col("comp").alias("above"))
            jumped = moved.join(up, F.col("comp") == F.col("over"), "left").select(
                "node", "was", F.least("comp", F.coalesce("above", "comp")).alias("comp")
            )
            jumped = store(jumped, "labels", keep=True)
        labels = jumped.select("node", "comp")
        if jumped.where("was <> comp").isEmpty():
            return labels
