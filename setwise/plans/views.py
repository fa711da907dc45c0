"""The test tables seen as sessions: users' event histories play the recordings."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setwise.operators.ordered import Axis, fit_axis, per_session

CHUNK_US = 3 * 86_400_000_000
"""Three days: short enough to cut every user's history into several chunks."""


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with session key, epoch microseconds and three buttons."""
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("filename"),
        "event_id",
        "event_type",
        "value",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        kind.isin("click", "error", "purchase").cast("int").alias("trough"),
        kind.isin("view", "error").cast("int").alias("peak"),
        kind.isin("purchase", "error").cast("int").alias("start_end_excercise"),
    )


def sessions(spark: SparkSession, sf_dir: str, chunked: bool = False) -> tuple[DataFrame, Axis]:
    """One session per user, with ``time_us`` and ``time_vector`` (seconds) since its
    first event. ``chunked`` forces the scan that is meant for heavy sessions."""
    rows = event_rows(spark, sf_dir)
    clock = fit_axis(rows, ("filename",), "ts_us", ("event_id",))
    if chunked:
        clock = replace(clock, chunk=CHUNK_US)
    since_start = F.col("ts_us") - F.col("__start")
    rows = per_session(rows, clock, __start=("min", F.col("ts_us"))).withColumns(
        {"time_us": since_start, "time_vector": since_start / 1e6}
    )
    return rows.drop("__start", "ts_us"), replace(clock, time="time_us")
