"""Golden sessions and random button sequences, on a plain and on a chunked axis."""

import random

import pytest
from pyspark.sql import functions as F
from recordings import DEADLIFT, SQUAT, by_session, samples

from setwise.operators import signals
from setwise.operators.ordered import Axis, cumulate, fit_axis, neighbours, rolling_max, row_numbers

PLAIN = Axis(("filename",), "time_vector")
CHUNKED = Axis(("filename",), "time_vector", chunk=0.035)
AXES = pytest.mark.parametrize("axis", [PLAIN, CHUNKED], ids=["plain", "chunked"])


def digits(text):
    return [int(c) for c in text]


@AXES
def test_edges_ignore_the_first_row_and_count_the_last(spark, axis):
    df = samples(spark, first="pp..p", last="....p")
    df = signals.edges(df, axis, "peak", "rise", "fall")
    assert by_session(df, "rise") == {"first": digits("00001"), "last": digits("00001")}
    assert by_session(df, "fall") == {"first": digits("00100"), "last": digits("00000")}
    one = signals.rising_edge(samples(spark, first="pp..p"), axis, F.col("peak"), "r")
    assert by_session(one, "r") == {"first": digits("00001")}


@AXES
def test_a_missing_signal_makes_no_edge(spark, axis):
    df = samples(spark, x="p.p.p").withColumn("peak", F.when(F.col("time_vector") != 0.02, F.col("peak")))
    df = signals.edges(df, axis, "peak", "rise", "fall")
    assert by_session(df, "rise", "fall")["x"] == [(0, 0), (0, 1), (0, 0), (0, 0), (1, 0)]


@AXES
def test_island_ids_differ_between_runs_and_legacy_ids_may_not(spark, axis):
    df = samples(spark, x="..pp..p")
    assert by_session(signals.island_id(df, axis, "peak", "run"), "run")["x"] == [1, 1, 2, 2, 3, 3, 4]
    assert by_session(signals.island_id(df, axis, "peak", "run", legacy=True), "run")["x"] == [0, 0, 2, 2, 2, 2, 4]


@AXES
def test_class_comes_from_the_largest_code_of_the_first_run(spark, axis):
    df = samples(spark, squat=SQUAT, deadlift=DEADLIFT, none="......", mixed="..tpd...aa", early="dd..")
    df = signals.class_code(signals.first_event_run(df, axis, "first"), axis, "first", "code")
    codes = {name: set(values) for name, values in by_session(df, "code").items()}
    assert codes == {"squat": {7}, "deadlift": {5}, "none": {0}, "mixed": {5}, "early": {5}}
    assert by_session(df, "first")["mixed"] == digits("0011100000")
    blank = signals.blank_first_run(df, "first")
    assert by_session(blank, *signals.BUTTONS)["early"] == [(0, 0, 0)] * 4


@AXES
def test_latch_spans_first_press_to_second_release(spark, axis):
    df = samples(spark, x="..ss...ss..s.", open="..s..", pressed="ss..ss..")
    df = signals.toggle_latch(df, axis, signals.START_END, "latch")
    assert by_session(df, "latch") == {
        "x": digits("0011111110011"), "open": digits("00111"), "pressed": digits("00111111"),
    }


@AXES
def test_labels_of_a_squat_session(spark, axis):
    text = "..aa..ss.p..tt..p.ss.."
    df = signals.label_session(samples(spark, x=text, y="......"), axis)
    got = by_session(df, *signals.LABELS)
    assert [r[0] for r in got["x"]] == [7] * 22
    assert [r[1] for r in got["x"]] == [7 if c == "1" else 0 for c in "0000001111111111111100"]
    #  ..aa..ss.p..tt..p.ss..
    assert [r[2] for r in got["x"]] == digits("0000000000110000011100")
    assert [r[3] for r in got["x"]] == digits("0000001110000011000000")
    assert got["y"] == [(0, 0, 0, 0)] * 6
    relative = [round(t, 2) for t in by_session(df, "relative_time")["x"]]
    assert relative[:8] == [0, 0.01, 0.02, 0.03, 0.04, 0.05, 0, 0.01] and relative[20:] == [0, 0.01]


@AXES
def test_a_stretch_between_two_peaks_gets_both_labels(spark, axis):
    df = signals.label_session(samples(spark, x=".a.s.p...p.ss."), axis)
    assert by_session(df, "eccentric", "concentric")["x"][6:9] == [(1, 1)] * 3


def machine(rows):
    """The labels of one session, sample by sample, in plain Python."""
    pressed = [any(r) for r in rows]
    start = pressed.index(True) if True in pressed else len(rows)
    end = start
    while end < len(rows) and pressed[end]:
        end += 1
    code = max((4 * s + 2 * p + t for t, p, s in rows[start:end]), default=0)
    rows = [(0, 0, 0) if start <= i < end else r for i, r in enumerate(rows)]
    rises = falls = 0
    latch = []
    for i, (_, _, s) in enumerate(rows):
        before = rows[i - 1][2] if i else s
        rises, falls = rises + (s > before), falls + (s < before)
        latch.append(int(rises % 2 or falls % 2))
    inside = [int(on and code and not t and not p) for on, (t, p, _) in zip(latch, rows)]
    labels = []
    for i, flag in enumerate(inside):
        if not flag:
            labels.append((0, 0))
            continue
        a = b = i
        while a and inside[a - 1]:
            a -= 1
        while b + 1 < len(rows) and inside[b + 1]:
            b += 1
        before = rows[a - 1] if a else (0, 0, 0)
        after = rows[b + 1] if b + 1 < len(rows) else (0, 0, 0)
        labels.append((int(before[1] or after[0]), int(before[0] or after[1])))
    return [(code, code if on else 0, *label) for on, label in zip(latch, labels)]


def random_sessions(seed, count=40, length=60):
    draw = random.Random(seed)
    found = {}
    for n in range(count):
        text = ""
        while len(text) < length:
            text += draw.choice(".....tpsad") * draw.randint(1, 4)
        found[f"s{n}"] = text[: draw.randint(1, length)]
    return found


@AXES
@pytest.mark.parametrize("seed", [1, 2])
def test_labels_equal_a_state_machine(spark, axis, seed):
    from recordings import buttons

    texts = random_sessions(seed)
    got = by_session(signals.label_session(samples(spark, **texts), axis), *signals.LABELS)
    assert got == {name: machine(buttons(text)) for name, text in texts.items()}


def test_legacy_labels_agree_on_both_axes(spark):
    df = samples(spark, **random_sessions(3))
    plain, chunked = (signals.label_session(df, axis, legacy=True) for axis in (PLAIN, CHUNKED))
    columns = (*signals.LABELS, "relative_time")
    assert by_session(plain, *columns) == by_session(chunked, *columns)


@AXES
def test_properties_of_random_signals(spark, axis):
    df = samples(spark, **random_sessions(4))
    df = signals.edges(df, axis, "peak", "rise", "fall")
    df = signals.island_id(df, axis, "peak", "run")
    for rows in by_session(df, "peak", "rise", "fall", "run").values():
        steps = [r - f for _, r, f, _ in rows if r or f]
        assert all(a != b for a, b in zip(steps, steps[1:])), "rises and falls must alternate"
        for (p0, *_, run0), (p1, *_, run1) in zip(rows, rows[1:]):
            assert run1 - run0 == (p0 != p1)


@AXES
def test_scans_carry_over_chunk_borders(spark, axis):
    texts = random_sessions(5, count=10)
    df = samples(spark, **texts).withColumn("v", F.when(F.col("peak") == 1, F.col("time_vector")))
    df = cumulate(df, axis, sums={"n": F.lit(1), "peaks": F.col("peak")}, last={"seen": F.col("v")})
    df = neighbours(row_numbers(df, axis, "rn"), axis, lag={"prev": F.col("rn")}, lead={"next": F.col("rn")})
    df = rolling_max(df, axis, F.col("v"), "high", 3, 2)
    for rows in by_session(df, "v", "n", "peaks", "seen", "rn", "prev", "next", "high", "peak").values():
        peaks, seen = 0, None
        for i, (v, n, p, s, rn, prev, after, high, peak) in enumerate(rows):
            peaks, seen = peaks + peak, seen if v is None else v
            near = [r[0] for r in rows[max(0, i - 3) : i + 3] if r[0] is not None]
            assert (n, p, s, rn, high) == (i + 1, peaks, seen, i + 1, max(near, default=None))
            assert (prev, after) == (i or None, i + 2 if i + 1 < len(rows) else None)


@pytest.mark.parametrize("before, after", [(50, 50), (5, 0), (0, 4), (1, 9), (0, 0)])
@pytest.mark.parametrize("chunk", [0.005, 0.035, 0.21, 0.9])
def test_rolling_max_over_chunks_of_any_size(spark, before, after, chunk):
    """Chunks of one row, shorter and longer than the reach, and gaps between rows."""
    draw = random.Random(8)
    rows = [(f"s{n}", draw.choice([0.01, 0.01, 0.3]) * i, i, draw.choice([None, *range(50)])) for n in range(4) for i in range(150)]
    df = spark.createDataFrame(rows, "filename string, time_vector double, n int, v int").repartition(5)
    plain = Axis(("filename",), "time_vector", ("n",))
    high = [
        sorted(map(tuple, rolling_max(df, axis, F.col("v"), "high", before, after).collect()), key=repr)
        for axis in (plain, Axis(plain.keys, plain.time, plain.ties, chunk))
    ]
    assert high[0] == high[1]


def test_fit_axis_chunks_only_heavy_sessions(spark):
    df = samples(spark, small="....", heavy="." * 500)
    assert fit_axis(df, ("filename",), "time_vector").chunk is None
    axis = fit_axis(df, ("filename",), "time_vector", max_rows=100)
    heaviest = axis.split(df).groupBy(*axis.cell).count().agg(F.max("count")).first()[0]
    assert heaviest <= 100
    # A burst: most samples of the session lie in a thousandth of its time.
    burst = df.where("filename = 'heavy'").withColumn(
        "time_vector", F.when(F.col("time_vector") < 4, F.col("time_vector") / 1000).otherwise(F.col("time_vector"))
    )
    axis = fit_axis(burst, ("filename",), "time_vector", max_rows=100)
    assert axis.split(burst).groupBy(*axis.cell).count().agg(F.max("count")).first()[0] <= 100
    # Samples of one instant cannot be separated; the scan stays right.
    same = samples(spark, x="p.p.p").withColumns({"n": F.col("time_vector"), "time_vector": F.lit(0.0)})
    axis = fit_axis(same, ("filename",), "time_vector", ("n",), max_rows=2)
    got = signals.island_id(same, axis, "peak", "run").orderBy("n").collect()
    assert [r["run"] for r in got] == [1, 2, 3, 4, 5]


def test_an_empty_frame_stays_empty(spark):
    df = samples(spark, x=".").where("false")
    axis = fit_axis(df, ("filename",), "time_vector")
    assert signals.label_session(df, axis).count() == 0


def test_operators_leave_no_scratch_columns(spark):
    df = samples(spark, x=SQUAT)
    for axis in (PLAIN, CHUNKED):
        out = signals.label_session(df, axis)
        assert not [c for c in out.columns if c.startswith("__")]
        assert set(out.columns) == {*df.columns, *signals.LABELS, "relative_time"}
