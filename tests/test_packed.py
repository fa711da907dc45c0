"""Packed tables, files of many sessions, and validation without a Python function a row."""

import re

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from setwise import contract as C
from setwise.operators import models
from setwise.operators.relational import key_bucket
from setwise.session import stored, work_dir
from setwise.sources import tables
from setwise.sources.change_log import KINDS, ChangeLog
from setwise.sources.files import exists
from setwise.streaming.ingest import ingest

PARTS = [f"p {i}:" for i in range(12)]


@pytest.fixture()
def few(monkeypatch):
    """Two folders, so that values share them."""
    monkeypatch.setattr(tables, "PACKS", 2)


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k int, v string, part string")


def content(df):
    return sorted(map(tuple, df.select("k", "v", "part").collect()), key=repr)


def values(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "part string")


def test_values_share_files_and_are_replaced_alone(spark, few):
    target, rows = work_dir(spark, "t"), [(i, "v", part) for i, part in enumerate([*PARTS, None])]
    tables.replace_packed(frame(spark, *rows), target, "part", values(spark))
    assert len(tables.read_table(spark, target).inputFiles()) <= 4, "no folder for a value"
    touched = values(spark, PARTS[1], PARTS[2], "absent", None)
    tables.replace_packed(frame(spark, (90, "w", PARTS[1])), target, "part", touched)
    want = sorted([*[r for r in rows[:-1] if r[2] not in PARTS[1:3]], (90, "w", PARTS[1])], key=repr)
    assert content(tables.read_table(spark, target)) == want
    capped = work_dir(spark, "t")
    tables.replace_packed(frame(spark, *rows), capped, "part", values(spark), 2)
    files = tables.read_table(spark, capped).groupBy(F.col("_metadata.file_path")).count()
    assert files.agg(F.max("count")).first()[0] == 2
    read = tables.read_touched(spark, target, values(spark, PARTS[3], "absent"), "part", frame(spark).schema)
    assert content(read) == [(3, "v", PARTS[3])]
    tables.replace_packed(frame(spark), target, "part", values(spark, *PARTS))
    assert content(tables.read_table(spark, target, frame(spark).schema)) == []


def test_a_packed_table_survives_a_crash_while_folders_move(spark, few, monkeypatch):
    target, log = work_dir(spark, "t"), ChangeLog(spark, work_dir(spark, "log"))
    rows = [(i, "v", part) for i, part in enumerate(PARTS)]
    options = dict(keys=["k", "part"], partition="part", schema=frame(spark).schema, log=log, packed=True)
    tables.upsert(spark, target, frame(spark, *rows), delivery=0, **options)
    second = frame(spark, (0, "w", PARTS[0]), (50, "n", PARTS[0]))
    with monkeypatch.context() as m:
        m.setattr(tables, "rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.upsert(spark, target, second, delivery=1, **options)
    tables.upsert(spark, target, second, delivery=1, **options)
    assert content(tables.read_table(spark, target)) == sorted([*rows[1:], (0, "w", PARTS[0]), (50, "n", PARTS[0])], key=repr)
    told = log.read(frame(spark).schema, 1, 1, KINDS, True)
    assert sorted(r["_change_type"] for r in told.collect()) == ["insert", "update_postimage", "update_preimage"]


def test_many_sessions_come_in_few_files(spark):
    landing, bronze, state = (work_dir(spark, n) for n in ("landing", "bronze", "state"))
    cells = [F.lit(1.5).cast(f.dataType).alias(f.name) for f in C.SESSION_FILE if f.name != "timevector"]
    rows = spark.range(1200).select((F.col("id") % 2).cast("double").alias("timevector"), *cells, F.concat((F.col("id") / 2).cast("int"), F.lit(".csv")).alias("session"))
    rows.coalesce(1).write.option("header", True).csv(f"{landing}/recorder=r")
    name = F.concat_ws("_", F.regexp_extract("_metadata.file_path", "recorder=([^/]+)", 1), "session")
    ingest(spark, landing, bronze, state, name=name, session="session")
    found = spark.read.schema(C.BRONZE).parquet(bronze)
    assert found.count() == 1200 and found.where("filename = 'r_7.csv'").count() == 2 and found.where("_rescued_data is not null").isEmpty()
    assert len(found.inputFiles()) <= tables.PACKS < found.select("filename").distinct().count() == 600


def test_validation_by_group_is_that_of_a_cross_validator(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 60).alias("g"), (F.col("id") % 7).cast("double").alias("a"), F.pmod(F.hash("id"), F.lit(5)).cast("double").alias("b"),
        ((F.col("id") % 7 > 3) & (F.pmod(F.hash("id"), F.lit(5)) > 0)).cast("int").alias("y"),
    )
    spec = models.ModelSpec("m", "y", "tree", ("a", "b"), {"maxDepth": 2})
    f1 = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName="f1")
    folded = rows.select("a", "b", "y", key_bucket("g", C.SPLIT_SEED + 1, 5).alias("fold"))
    theirs = CrossValidator(
        estimator=spec.pipeline(), estimatorParamMaps=ParamGridBuilder().build(), evaluator=f1, numFolds=5, foldCol="fold", seed=C.SPLIT_SEED
    ).fit(folded)
    ours = models.validate_by_group(spec, rows, "g")
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics) and 0.5 < ours.avgMetrics[0] <= 1
    # Sums of the scaler depend on how rows lie in tasks, so the last digits of a split may differ.
    trees = [re.sub(r"\d+\.\d{6,}", lambda n: f"{float(n[0]):.9f}", m.bestModel.stages[-1].toDebugString.split("\n", 1)[1]) for m in (ours, theirs)]
    assert trees[0] == trees[1]
    with pytest.raises(ValueError, match="empty"):
        models.validate_by_group(spec, rows.where("g = 1"), "g")


def test_shares_are_worked_out_once(spark):
    rows = models.with_shares(spark.range(10).withColumn("g", F.col("id")), "g")
    assert models.with_shares(rows, "g") is rows
    with models.kept(rows, ["g", models.FOLD, "g"]) as held:
        assert held.columns == ["g", models.FOLD] and held.count() == 10
        path = held.inputFiles()[0].rsplit("/", 1)[0]
    assert not exists(spark, path)
    assert "ExistingRDD" not in stored(rows)._jdf.queryExecution().toString()
