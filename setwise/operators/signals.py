"""Signal operators: from button presses to sets and lift phases.

Every operator takes a frame and an ``Axis`` and adds columns. Signals are 0/1
integers; a missing signal counts as neither on nor off.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setwise.operators.ordered import (
    CHUNK,
    Axis,
    cumulate,
    neighbours,
    ordered,
    per_run,
    per_session,
    transitions,
)
from setwise.session import cut

TROUGH, PEAK, START_END = "trough", "peak", "start_end_excercise"
BUTTONS = (TROUGH, PEAK, START_END)

Signal = str | Column


def _on(signal: Signal) -> Column:
    return (F.col(signal) if isinstance(signal, str) else signal).cast("boolean")


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def any_pressed() -> Column:
    return _on(TROUGH) | _on(PEAK) | _on(START_END)


@ordered
def edges(
    df: DataFrame, axis: Axis, signal: Signal, rising: str | None = None, falling: str | None = None
) -> DataFrame:
    """Mark the rows where ``signal`` goes on and/or off. The first row has no edge."""
    now, before = _on(signal), F.col("__before")
    df = neighbours(df, axis, lag={"__before": now})
    marks = {}
    if rising:
        marks[rising] = _flag(now & ~before)
    if falling:
        marks[falling] = _flag(~now & before)
    return df.withColumns(marks).drop("__before")


def rising_edge(df: DataFrame, axis: Axis, signal: Signal, out: str) -> DataFrame:
    return edges(df, axis, signal, rising=out)


def falling_edge(df: DataFrame, axis: Axis, signal: Signal, out: str) -> DataFrame:
    return edges(df, axis, signal, falling=out)


def _rises(before: Column, now: Column, first: Column) -> Column:
    return now & ~before


def _falls(before: Column, now: Column, first: Column) -> Column:
    return ~now & before


def _starts(before: Column, now: Column, first: Column) -> Column:
    return now & (first | ~before)


def _changes(before: Column, now: Column, first: Column) -> Column:
    return first | ~now.eqNullSafe(before)


def _value(signal: Signal) -> Column:
    return F.col(signal) if isinstance(signal, str) else signal


@ordered
def island_id(df: DataFrame, axis: Axis, flag: Signal, out: str, legacy: bool = False) -> DataFrame:
    """Number the runs of rows with an equal flag.

    The default id counts changes and is unique within a session. ``legacy`` gives
    the difference of the row numbers per session and per (session, flag), that is
    the rows so far with the other flag: an on-run and an off-run may share it.
    """
    if not legacy:
        return transitions(df, axis, _value(flag), counts={out: _changes})
    on = F.col("__on")
    df = cumulate(df.withColumn("__on", _flag(_on(flag))), axis, sums={"__ons": on, "__offs": 1 - on})
    return df.withColumn(out, F.when(on == 1, F.col("__offs")).otherwise(F.col("__ons"))).drop("__on", "__ons", "__offs")


@ordered
def first_event_run(df: DataFrame, axis: Axis, out: str, pressed: Column | None = None) -> DataFrame:
    """Mark the rows of the first run in which any button is down."""
    pressed = F.coalesce(any_pressed() if pressed is None else pressed, F.lit(False))
    df = transitions(df, axis, pressed, counts={"__presses": _starts})
    return df.withColumn(out, _flag(pressed & (F.col("__presses") == 1))).drop("__presses")


@ordered
def class_code(df: DataFrame, axis: Axis, first_run: str, out: str) -> DataFrame:
    """The exercise class of a session: the largest button code of its first run."""
    code = 4 * F.col(START_END) + 2 * F.col(PEAK) + F.col(TROUGH)
    df = per_session(df, axis, **{out: ("max", F.when(F.col(first_run) == 1, code))})
    return df.withColumn(out, F.coalesce(out, F.lit(0)).cast("int"))


def blank_first_run(df: DataFrame, first_run: str) -> DataFrame:
    """The first run names the exercise; it is no marker, so clear its buttons."""
    return df.withColumns(
        {b: F.when(F.col(first_run) == 1, F.lit(0)).otherwise(F.col(b)) for b in BUTTONS}
    )


@ordered
def toggle_latch(df: DataFrame, axis: Axis, signal: Signal, out: str) -> DataFrame:
    """On from a first press up to the row before the release of the second press."""
    df = transitions(df, axis, _on(signal), counts={"__rises": _rises, "__falls": _falls})
    odd = (F.col("__rises") % 2 != 0) | (F.col("__falls") % 2 != 0)
    return df.withColumn(out, odd.cast("int")).drop("__rises", "__falls")


def active_class(df: DataFrame, latch: str, code: str, out: str) -> DataFrame:
    return df.withColumn(out, F.when(F.col(latch) == 1, F.col(code)).otherwise(F.lit(0)))


@ordered
def run_start(df: DataFrame, axis: Axis, flag: Signal, out: str, legacy: bool = False) -> DataFrame:
    """The time at which the current run of ``flag`` began."""
    if not legacy:
        return transitions(df, axis, _value(flag), since={out: _changes})
    df = island_id(df, axis, flag, "__run", legacy=True)
    return per_run(df, axis, "__run", **{out: ("min", F.col(axis.time))}).drop("__run")


def relative_time(df: DataFrame, axis: Axis, flag: Signal, out: str, legacy: bool = False) -> DataFrame:
    df = run_start(df, axis, flag, "__start", legacy)
    return df.withColumn(out, F.col(axis.time) - F.col("__start")).drop("__start")


def in_phase(active: str) -> Column:
    """Inside a set and between two markers."""
    return _flag((F.col(active) != 0) & ~(_on(PEAK) | _on(TROUGH)))


@ordered
def phase_labels(
    df: DataFrame,
    axis: Axis,
    active: str,
    eccentric: str = "eccentric",
    concentric: str = "concentric",
    legacy: bool = False,
    settle: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Label the stretches between markers by the markers around them.

    Eccentric comes after a peak or before a trough, concentric after a trough or
    before a peak; a stretch may get both. ``settle`` may cut the lineage halfway.
    """
    df = neighbours(
        df,
        axis,
        lag={"__peak_before": F.col(PEAK), "__trough_before": F.col(TROUGH)},
        lead={"__peak_after": F.col(PEAK), "__trough_after": F.col(TROUGH)},
    )
    inside = in_phase(active)
    lowering = (inside == 1) & ((F.col("__peak_before") == 1) | (F.col("__trough_after") == 1))
    lifting = (inside == 1) & ((F.col("__trough_before") == 1) | (F.col("__peak_after") == 1))
    around = ("__peak_before", "__trough_before", "__peak_after", "__trough_after")
    rest = [c for c in df.columns if c not in around]
    df = df.select(*rest, _flag(lowering).alias("__lowering"), _flag(lifting).alias("__lifting"))
    df = settle(island_id(df, axis, inside, "__run", legacy))
    labels = {eccentric: ("max", F.col("__lowering")), concentric: ("max", F.col("__lifting"))}
    return per_run(df, axis, "__run", **labels).drop("__lowering", "__lifting", "__run")


LABELS = ("excercise_id", "start_end_excercise_id", "eccentric", "concentric")


def _label(df: DataFrame, axis: Axis, legacy: bool, settle) -> DataFrame:
    df = first_event_run(df, axis, "__first_run")
    df = settle(class_code(df, axis, "__first_run", "excercise_id"))
    df = blank_first_run(df, "__first_run").drop("__first_run")
    df = toggle_latch(df, axis, START_END, "__latch")
    df = active_class(df, "__latch", "excercise_id", "start_end_excercise_id")
    df = settle(run_start(df, axis, "__latch", "__run_start", legacy))
    df = phase_labels(df, axis, "start_end_excercise_id", legacy=legacy, settle=settle)
    return df.withColumn(START_END, F.col("__latch")).drop("__latch")


def label_session(df: DataFrame, axis: Axis, legacy: bool = False) -> DataFrame:
    """All labels of a session from its three buttons.

    Adds ``excercise_id``, ``start_end_excercise_id``, ``eccentric``, ``concentric``
    and ``relative_time``; clears the markers of the first run and turns
    ``start_end_excercise`` into the latched state.

    On a chunked axis the buttons are first reduced to their state changes (people
    press a few times a minute, sensors write a hundred rows a second). The labels
    are worked out on those and held until the next change in each chunk.
    """
    if axis.chunk is None:
        labelled = _label(df, axis, legacy, settle=lambda df: df)
    elif legacy:  # the old run ids count rows, so they need all of them
        labelled = _label(axis.split(df), axis, legacy, settle=cut)
    else:
        rows = axis.split(df)
        labels = _label(cut(_state_changes(rows, axis)), axis, legacy, settle=cut)
        labelled = hold_labels(rows.drop(*BUTTONS), labels, axis)
    labelled = labelled.withColumn("relative_time", F.col(axis.time) - F.col("__run_start"))
    return labelled.drop("__run_start", CHUNK)


def _state_changes(rows: DataFrame, axis: Axis) -> DataFrame:
    """The rows at which a button changes, and the first row of each chunk."""
    state = F.struct(*BUTTONS)
    narrow = rows.select(*axis.cell, *axis.order, *BUTTONS)
    return narrow.withColumn("__before", F.lag(state).over(axis.rows())).where(~state.eqNullSafe(F.col("__before"))).drop("__before")


def hold_labels(rows: DataFrame, labels: DataFrame, axis: Axis) -> DataFrame:
    """Give each row the labels of the latest change in its chunk. A union and one
    window: the wide rows are shuffled once, by chunk, and not joined."""
    held = [c for c in labels.columns if c not in {*axis.cell, *axis.order}]
    labels = labels.select(*axis.cell, *axis.order, F.struct(*held).alias("__labels"), F.lit(0).alias("__side"))
    both = rows.withColumn("__side", F.lit(1)).unionByName(labels, allowMissingColumns=True)
    w = Window.partitionBy(*axis.cell).orderBy(*axis.order, "__side")
    latest = F.last("__labels", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("__held", latest).where("__side = 1").select(*rows.columns, "__held.*")
