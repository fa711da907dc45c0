"""Trained models and their measurements, by run."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.sources.tables import read_table

RUNS = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("model", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


@dataclass
class RunStore:
    """``runs/`` holds one row per model and run, ``models/<run>/<model>`` the models."""

    spark: SparkSession
    path: str
    _started: dict = field(default_factory=dict)

    def start(self) -> str:
        run_id = uuid.uuid4().hex
        self._started[run_id] = self.spark.range(1).select(F.now()).first()[0]
        return run_id

    def save(self, run_id: str, run_name: str, name: str, model: PipelineModel, params: dict, metrics: dict) -> None:
        """Store the model first: a run that can be found can be loaded."""
        model.write().overwrite().save(f"{self.path}/models/{run_id}/{name}")
        row = (
            run_name,
            run_id,
            self._started[run_id],
            name,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()},
        )
        self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(f"{self.path}/runs")

    def runs(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/runs", RUNS)

    def latest(self, run_name: str, models: int = 1) -> Row | None:
        """The newest run of that name in which at least ``models`` models are stored."""
        return (
            self.runs()
            .where(F.col("run_name") == run_name)
            .groupBy("run_id")
            .agg(F.max("start_time").alias("start_time"), F.countDistinct("model").alias("n"))
            .where(F.col("n") >= models)
            .orderBy(F.col("start_time").desc(), F.col("run_id").desc())
            .first()
        )

    def load(self, run_id: str, name: str) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/models/{run_id}/{name}")
