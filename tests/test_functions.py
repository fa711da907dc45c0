"""Scalar functions, cleaning, resampling, small reports."""

import datetime
import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from setwise import contract as C
from setwise.functions import scalars as S
from setwise.operators import cleaning, phases, relational
from setwise.operators.ordered import Axis


def one(df, expr):
    return df.select(expr.alias("v")).first()["v"]


def test_names_and_times(spark):
    df = spark.createDataFrame([("/data/20240115-101112_000123_MPU6500_fixture.csv",)], "name string")
    start = datetime.datetime(2024, 1, 15, 10, 11, 12, 123)
    assert one(df, S.base_name("name")) == "20240115-101112_000123_MPU6500_fixture.csv"
    assert one(df, S.device_version("name")) == "MPU6500"
    assert one(df, S.session_start("name")) == start
    at = S.wall_time(S.session_start("name"), F.lit(1.5))
    assert one(df, at) == start + datetime.timedelta(seconds=1.5)
    assert one(df, S.wall_time_text(S.session_start("name"), F.lit(61.99))) == "2024-01-15 10:12:13"
    for bad in ("notes.csv", "20249999-999999_000000_x.csv"):
        assert one(df, S.session_start(F.lit(bad))) is None
        assert one(df, S.wall_time_text(S.session_start(F.lit(bad)), F.lit(1.0))) is None


def test_class_names(spark):
    df = spark.createDataFrame([(7.0,), (5.0,), (3.0,), (None,)], "code double")
    assert [r[0] for r in df.select(S.class_name("code")).collect()] == ["Squat", "Deadlift", "Unknown", "Unknown"]


def test_celsius_and_rotation(spark):
    df = spark.range(1)
    assert one(df, S.celsius(F.lit(340))) == pytest.approx(37.53)
    half = math.sqrt(0.5)  # a quarter turn around z takes x to y
    turned = S.to_world_frame([F.lit(1.0), F.lit(2.0), F.lit(3.0)], [F.lit(half), F.lit(0.0), F.lit(0.0), F.lit(half)])
    assert df.select(*turned).first() == pytest.approx((-2.0, 1.0, 3.0))


def test_clean_samples_drops_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1.0, 0.0, "a"), (2, inf, 1.0, "a"), (3, nan, 1.0, "a"), (4, None, 1.0, "a"), (5, 0.0, 1.0, "a"),
            (6, 1.0, -inf, "a"), (7, 1.0, 1.0, None), (0, 2.0, 2.0, "a")]
    df = spark.createDataFrame(rows, "id int, axis double, other double, text string")
    assert sorted(r["id"] for r in cleaning.clean_samples(df, ["axis"]).collect()) == [0, 1]


def test_raster_and_downsampling(spark):
    df = spark.createDataFrame([(i / 100,) for i in range(0, 200)], "time_vector double")
    assert cleaning.downsample(df, 20).count() == 100
    assert cleaning.downsample(df, 100).count() == 20
    assert cleaning.downsample(df, 500).count() == 4
    row = cleaning.raster_columns(spark.createDataFrame([(1234.123,)], "time_vector double")).first()
    assert tuple(row) == (1234.123, 1234, 1234.1, 1234.12, 0.1, 0.02)
    assert cleaning.resample_where(df, F.col("dec_10ms") == 0).columns == ["time_vector"]
    assert cleaning.resample_where(df, None) is df
    with pytest.raises(ValueError):
        cleaning.downsample(df, 25)


def test_missing_columns_fail_before_any_job(spark):
    with pytest.raises(ValueError, match="b, c"):
        cleaning.select_renamed(spark.createDataFrame([(1,)], "a int"), {"a": "x", "b": "y", "c": "z"})


def test_contract_names_line_up():
    assert len(C.RAW) == len(C.CHANNELS) == 38 and len(C.FEATURES) == 35 and len(C.RAW_AXES) == 12
    assert C.RENAMES["wgz2"] == "worldGyroZ_cs" and C.RENAMES["button1"] == "trough"
    assert len(C.TRAINING) == 45
    assert len(C.PRODUCTION) == 39


def test_metrics_equal_the_evaluators(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0), (5.0, 7.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = relational.confusion_metrics(df, "label").first()
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        want = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(df)
        assert got[ours] == pytest.approx(want), ours


def test_split_by_key_keeps_keys_together_and_repeats(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("key"))
    train, test = relational.split_by_key(df, "key", 80, 42)
    a, b = ({r[0] for r in part.distinct().collect()} for part in (train, test))
    again = {r[0] for r in relational.split_by_key(df.repartition(7), "key", 80, 42)[0].distinct().collect()}
    assert a | b == set(range(100)) and not a & b and a == again and 60 < len(a) < 95


@pytest.mark.parametrize("chunk", [None, 2.0])
def test_hold_last_takes_the_latest_packet(spark, chunk):
    axis = Axis(("k",), "t", chunk=chunk)
    chest = spark.createDataFrame([("a", float(t)) for t in range(8)] + [("b", 1.0)], "k string, t double")
    wrist = spark.createDataFrame([("a", 1.0, 10), ("a", 1.5, 15), ("a", 6.0, None)], "k string, t double, w int")
    got = relational.align_hold_last(chest, wrist, axis, ["w"], stamp="at")
    rows = {(r["k"], r["t"]): (r["w"], r["at"]) for r in got.collect()}
    assert rows[("a", 0.0)] == (None, None) and rows[("a", 1.0)] == (10, 1.0) and rows[("b", 1.0)] == (None, None)
    assert rows[("a", 2.0)] == rows[("a", 5.0)] == (15, 1.5)
    assert rows[("a", 6.0)] == rows[("a", 7.0)] == (None, 6.0)


def test_an_axis_fits_both_sides(spark):
    """The left side has few rows; its axis alone would put the whole right side in one task."""
    left = spark.createDataFrame([("a", float(t)) for t in range(0, 1000, 100)], "k string, t double")
    right = spark.createDataFrame([("a", float(t), t) for t in range(1000)] + [("b", 1.0, 1)], "k string, t double, w int")
    axis = relational.fit_both(left, right, ("k",), "t", max_rows=50)
    assert axis.chunk is not None and relational.fit_both(left, left, ("k",), "t", max_rows=50).chunk is None
    got = relational.align_hold_last(left, right, axis, ["w"]).collect()
    assert {(r["t"], r["w"]) for r in got} == {(float(t), t) for t in range(0, 1000, 100)}


def marked_rows(spark):
    """Two sets of squats with a pause: (time, code, concentric, eccentric)."""
    script = [(0, 0, 0), (0, 0, 0), (7, 1, 0), (7, 1, 0), (7, 0, 0), (7, 0, 1), (7, 0, 1), (0, 0, 0), (0, 0, 0),
              (0, 0, 0), (7, 1, 0), (7, 1, 0), (7, 0, 1), (7, 0, 1), (7, 1, 1), (0, 0, 0)]
    rows = [("f", None, float(i), float(c), float(u), float(d)) for i, (c, u, d) in enumerate(script)]
    return spark.createDataFrame(
        rows, "filename string, measure_date timestamp, time_vector double, start_end_excercise_id double,"
        " concentric double, eccentric double"
    )


@pytest.mark.parametrize("chunk", [None, 3.0])
def test_session_summary(spark, chunk):
    axis = Axis(("filename",), "time_vector", chunk=chunk)
    marked = phases.mark_phases(marked_rows(spark), axis, before=0, after=0)
    table = phases.phase_table(marked)
    got = phases.session_summary(phases.set_ids(table, phases.phase_axis(chunk))).first().asDict()
    assert got["excercise"] == "Squat" and got["sets"] == 2
    assert got["count_concentric_times"] == 2 and got["count_eccentric_times"] == 2 and got["reps"] == 2.0
    assert got["total_concentric_time"] == 2.0 and got["total_eccentric_time"] == 2.0
    assert got["total_rest_time"] == 1.0 + 0.0 + 2.0 + 0.0
    assert got["measure_date"] is None


def test_smoothing_fills_drop_outs(spark):
    axis = Axis(("filename",), "time_vector")
    smooth = phases.smooth_class(marked_rows(spark), axis, "start_end_excercise_id", "s", 2, 2)
    assert {r["s"] for r in smooth.where("time_vector < 15").collect()} == {7.0}


def test_rest_rules(spark):
    df = spark.createDataFrame([(3.0, 0, 0), (4.0, 1, 0), (5.0, 1, 1)], "time_vector double, concentric int, eccentric int")
    assert [r["rest_time"] for r in phases.time_markers(df).collect()] == [3.0, None, None]
    assert [r["rest_time"] for r in phases.time_markers(df, rest_rule="legacy").collect()] == [3.0, 4.0, 0.0]
    with pytest.raises(ValueError):
        phases.time_markers(df, rest_rule="other")


def test_plot_traces(spark):
    cells = ", ".join(f"accel{a}_{s} double" for s in ("cs", "ws") for a in "XYZ")
    df = spark.createDataFrame([(0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 9), (0.01, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 9)],
                               f"time_vector double, {cells}, events_groups int")
    got = phases.plot_traces(df, "accel", period_ms=100).collect()
    assert [tuple(r) for r in got] == [("chest", 1.0, 2.0, 3.0, 9), ("wrist", 504.0, 5.0, 6.0, 9)]
