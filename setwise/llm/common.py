"""Reading the corpus tables, writing intermediate tables, and small shared columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setwise.llm.words import WORD_PATTERN
from setwise.session import work_dir
from setwise.sources.files import remove


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_open_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``store`` wrote inside. What comes out of it must have been
    written elsewhere."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            remove(spark, path)


def store(df: DataFrame, label: str, *partition_on: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files: later steps read them
    instead of computing the rows again, also after an executor is lost. Inside ``scratch``
    the files go when it ends, unless they are to ``keep``: then the scratch around has them."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    around = _open_scratch[: -1 if keep else None]
    if around:
        around[-1].append(path)
    df.write.partitionBy(*partition_on).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD_PATTERN)).cast("long")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """Keep the rows of ``df`` in one column ``row`` beside computed columns, so that no
    column of ``df`` clashes with a name an operator uses. ``unpacked`` undoes it."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")
