"""Change records of a table by version, and readers that follow them as a stream.

``changes/_commit_version=N/`` holds the changed rows of version N; the folder appears there
as a whole, after the table has them. Versions are the numbers of deliveries, such as the
batch ids of the stream that writes, so a delivery that is repeated finds its version there.
Readers are streams over these folders: the checkpoint of a reader remembers what it read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.sources.files import exists, make_folder, names_in, remove, rename

VERSION = "_commit_version"
META = ("_change_type", VERSION, "_commit_timestamp")
KINDS = ("insert", "update_preimage", "update_postimage", "delete")


@dataclass(frozen=True)
class ChangeLog:
    spark: SparkSession
    path: str

    def _folder(self, version: int) -> str:
        return f"{self.path}/changes/{VERSION}={version}"

    def has(self, version: int) -> bool:
        return exists(self.spark, self._folder(version))

    def latest(self) -> int | None:
        prefix = f"{VERSION}="
        found = [int(n.removeprefix(prefix)) for n in names_in(self.spark, f"{self.path}/changes") if n.startswith(prefix)]
        return max(found, default=None)

    def outcome(self, version: int, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` gives, written down before the table changes: a delivery that is
        repeated goes on from there, as the table may already have it."""
        place = f"{self.path}/outcomes/{version}"
        if not exists(self.spark, f"{place}/_SUCCESS"):
            make().write.mode("overwrite").parquet(place)
        return self.spark.read.parquet(place)

    def publish(self, version: int, changes: DataFrame) -> None:
        """Show the changes of a version, all at once. The table must have them already."""
        draft = f"{self.path}/drafts/{version}"
        changes.withColumn("_commit_timestamp", F.now()).write.mode("overwrite").parquet(draft)
        make_folder(self.spark, f"{self.path}/changes")
        rename(self.spark, draft, self._folder(version))
        remove(self.spark, f"{self.path}/outcomes/{version}")

    def read(
        self,
        schema: T.StructType,
        from_version: int,
        to_version: int | None = None,
        kinds: Sequence[str] = ("insert",),
        keep_meta: bool = False,
    ) -> DataFrame:
        """Changed rows of the versions in the (inclusive) range; the version is a partition
        column, so only its folders are read."""
        if from_version is None:
            raise ValueError("from_version is needed")
        try:
            rows = self.spark.read.schema(_with_meta(schema)).parquet(f"{self.path}/changes")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], _with_meta(schema))
        wanted = (F.col(VERSION) >= from_version) & F.col("_change_type").isin(*kinds)
        rows = rows.where(wanted if to_version is None else wanted & (F.col(VERSION) <= to_version))
        return rows if keep_meta else rows.drop(*META)

    def follow(self, schema: T.StructType, checkpoint: str, use: Callable[[DataFrame, int], None]) -> None:
        """Give the change records of all versions not seen before to ``use``, with the number
        of the batch, and stop. A batch that fails comes again with the same records and the
        same number, so what ``use`` writes should be replaced by it."""
        make_folder(self.spark, f"{self.path}/changes")
        failed: list[Exception] = []

        def each(records: DataFrame, batch: int) -> None:
            try:
                use(records, batch)
            except Exception as error:
                failed.append(error)
                raise

        stream = self.spark.readStream.schema(_with_meta(schema)).parquet(f"{self.path}/changes")
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if failed:
                raise failed[0] from None
            raise


def new_rows(records: DataFrame, batch: int) -> DataFrame:
    """What a reader that takes a table and then its new rows gets from a batch of change
    records: of the first batch the table as these records make it, later the inserted rows.
    The log must have the table from its first row on."""
    if batch:
        return _only(records, "insert")
    return _only(records, "insert", "update_postimage").exceptAll(_only(records, "update_preimage", "delete"))


def _only(records: DataFrame, *kinds: str) -> DataFrame:
    return records.where(F.col("_change_type").isin(*kinds)).drop(*META)


def _with_meta(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            *schema.fields,
            T.StructField("_change_type", T.StringType()),
            T.StructField("_commit_timestamp", T.TimestampType()),
            T.StructField(VERSION, T.LongType()),
        ]
    )


def diff_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change records that lead from ``old`` to ``new``, by key: insert, delete and, for
    rows that differ, their images before and after. One full outer join."""
    columns = old.columns
    joined = (
        old.select(F.struct(*columns).alias("before"), *[F.col(k).alias(f"__o_{k}") for k in keys])
        .alias("o")
        .join(
            new.select(F.struct(*columns).alias("after"), *[F.col(k).alias(f"__n_{k}") for k in keys]).alias("n"),
            [F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}")) for k in keys],
            "full_outer",
        )
    )
    before, after = F.col("before"), F.col("after")
    both = before.isNotNull() & after.isNotNull() & ~before.eqNullSafe(after)

    def record(condition, row, kind):
        return F.when(condition, F.struct(row.alias("row"), F.lit(kind).alias("_change_type")))

    records = F.array_compact(
        F.array(
            record(before.isNull(), after, "insert"),
            record(after.isNull(), before, "delete"),
            record(both, before, "update_preimage"),
            record(both, after, "update_postimage"),
        )
    )
    return joined.select(F.explode(records).alias("r")).select("r.row.*", "r._change_type")
