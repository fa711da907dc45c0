"""Silver: clean, label and route the sessions of each micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from setwise import contract as C
from setwise.functions.scalars import base_name, device_version, session_start, wall_time_text
from setwise.operators.cleaning import clean_samples, resample_where, route, select_renamed
from setwise.operators.ordered import MAX_ROWS, Axis, fit_axis
from setwise.operators.signals import label_session
from setwise.sources.change_log import ChangeLog
from setwise.sources.tables import PACK, is_path, read_touched, upsert

KEYS = ("filename", "time_vector")
FILE = "__file"
BATCHES = "batch int, n_files long, n_rows long, n_bytes long, largest long"


def prepare_samples(bronze: DataFrame, condition: Column | None = None, device: str = C.SUPPORTED_DEVICE) -> DataFrame:
    """Valid samples of supported devices under their table names, with provenance. A
    recording that was delivered twice counts once."""
    rows = select_renamed(bronze.where(F.col("filename").contains(device)), C.RENAMES).dropDuplicates()
    rows = clean_samples(resample_where(rows, condition), C.RAW_AXES)
    rows = rows.withColumn("filename", base_name("filename"))
    start = session_start("filename")
    return rows.withColumns(
        {
            "measure_date": start,
            "timestamp": wall_time_text(start, "time_vector"),
            "mpuVersion": device_version("filename"),
        }
    )


def session_axis(bronze: DataFrame, max_rows: int = MAX_ROWS) -> Axis:
    """The scan for these sessions, measured on two columns of the raw rows."""
    timed = bronze.select(base_name("filename").alias("filename"), F.col("timevector").alias("time_vector"))
    timed = timed.where(F.abs("time_vector") < F.lit(float("inf")))
    return fit_axis(timed, ("filename",), "time_vector", max_rows=max_rows)


@dataclass(frozen=True)
class SilverJob:
    """Reads the bronze table as a stream and upserts into two tables. Tables are paths, where
    they are packed, or names of tables partitioned by session that were created before.

    A session is always labelled as a whole: the batch only says which sessions have
    new rows, and these are read again in full, from the folders that hold them only. They replace what
    either table has of them, so a session that moves from one table to the other leaves
    nothing behind. A batch that is delivered twice gives the same tables. The change logs lie
    beside the stream's own checkpoint, as their versions are its batch numbers: to read bronze
    once more, remove ``checkpoint`` as a whole. ``legacy`` keeps the old run ids that may
    merge runs.
    """

    spark: SparkSession
    bronze: str
    training: str
    production: str
    checkpoint: str
    condition: Column | None = None
    legacy: bool = False
    max_rows: int = MAX_ROWS
    max_bytes: int = C.BATCH_BYTES
    max_files: int | None = None

    def training_log(self) -> ChangeLog:
        return ChangeLog(self.spark, f"{self.checkpoint}/changes/training")

    def production_log(self) -> ChangeLog:
        return ChangeLog(self.spark, f"{self.checkpoint}/changes/production")

    def run(self) -> StreamingQuery:
        limit = ("maxFilesPerTrigger", self.max_files) if self.max_files else ("maxBytesPerTrigger", self.max_bytes)
        reader = self.spark.readStream.option(*limit)
        packed = T.StructType([*C.BRONZE.fields, T.StructField(PACK, T.IntegerType())])
        rows = reader.schema(packed).parquet(self.bronze) if is_path(self.bronze) else reader.table(self.bronze)
        rows = rows.withColumn(FILE, F.struct("_metadata.file_path", "_metadata.file_size")).drop(PACK)
        query = (
            rows.writeStream.foreachBatch(self.update)
            .outputMode("append")
            .option("checkpointLocation", f"{self.checkpoint}/stream")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return query

    def batches(self) -> DataFrame:
        """What each micro-batch read: ``batch``, ``n_files``, ``n_rows``, ``n_bytes`` and
        ``largest``, the bytes of its largest file."""
        return self.spark.read.schema(BATCHES).parquet(f"{self.checkpoint}/batches")

    def _note(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Write down the size of the batch, in the pass that finds its sessions."""
        seen, found = Observation(), [F.count(F.lit(1)).alias("n_rows")]
        files = batch.observe(seen, *found).groupBy("filename", FILE).agg(F.count(F.lit(1)).alias("n"))
        files = files.persist(StorageLevel.DISK_ONLY)
        size = F.col(f"{FILE}.file_size")
        sizes = files.select(FILE).distinct().agg(
            F.count(F.lit(1)).alias("n_files"), F.sum(size).alias("n_bytes"), F.max(size).alias("largest")
        )
        row = sizes.first()
        told = self.spark.range(1).select(
            F.lit(row["n_files"]).cast("long").alias("n_files"), F.lit(seen.get["n_rows"]).cast("long").alias("n_rows"),
            F.lit(row["n_bytes"]).cast("long").alias("n_bytes"), F.lit(row["largest"]).cast("long").alias("largest"),
        )
        told.write.mode("overwrite").parquet(f"{self.checkpoint}/batches/batch={batch_id}")
        return files

    def update(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = self._note(batch, batch_id) if FILE in batch.columns else batch
        touched = batch.select("filename").distinct()
        sessions = read_touched(spark, self.bronze, touched, "filename", C.BRONZE)
        names = touched.select(base_name("filename").alias("filename"))
        samples = prepare_samples(sessions, self.condition)
        axis = session_axis(sessions, self.max_rows)
        labelled = label_session(samples, axis, self.legacy).persist(StorageLevel.DISK_ONLY)
        try:
            training, production = route(labelled)
            for rows, target, schema, log in (
                (training, self.training, C.TRAINING, self.training_log()),
                (production, self.production, C.PRODUCTION, self.production_log()),
            ):
                upsert(spark, target, rows, KEYS, "filename", schema, log, batch_id, names, packed=is_path(target))
        finally:
            labelled.unpersist()
            batch.unpersist()
