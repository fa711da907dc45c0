"""Bronze: recorded files to a table partitioned by session, as a run-to-end stream."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from setwise.contract import BATCH_BYTES, SESSION_FILE
from setwise.sources.session_files import session_files
from setwise.sources.tables import PACK, is_path, pack_of

BLOCK, PARTS = "__block", 8
"""Files that a batch may add to one folder of bronze: a session of any length is written by so
many tasks."""


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    schema: T.StructType = SESSION_FILE,
    name: Column | None = None,
    max_bytes: int = BATCH_BYTES,
    max_files: int | None = None,
    session: str | None = None,
) -> StreamingQuery:
    """Append all files not seen before and stop. The checkpoint remembers the files. A path is
    a packed table: rows are gathered by folder, so that a batch adds few files."""
    rows = session_files(spark, landing, schema, name, True, max_bytes, max_files, session, BLOCK)
    folders = ["filename"]
    if is_path(bronze):
        rows = rows.withColumns({"filename": F.nullif("filename", F.lit("")), PACK: pack_of("filename")})
        rows, folders = rows.repartition(PACK, F.pmod(BLOCK, F.lit(PARTS))), [PACK]
    rows = rows.drop(BLOCK)
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*folders)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    query = writer.start(bronze) if is_path(bronze) else writer.toTable(bronze)
    query.awaitTermination()
    return query
