"""From predicted labels to sets, repetitions and session summaries.

On a chunked axis the rows of a chunk become stretches: neighbours with one label and one
state of movement, with their extreme times. Stretches of a chunk combine to runs, and the
runs of the chunks are numbered through a session by one summary row a chunk. So the rows
are shuffled once, and what is carried over borders is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setwise.contract import SMOOTHING_ROWS, UNKNOWN, WRIST_OFFSET
from setwise.functions.scalars import class_name
from setwise.operators.cleaning import downsample
from setwise.operators.ordered import CHUNK, Axis, beyond_border, near_border, numbered, ordered, rolling_max
from setwise.operators.signals import hold_labels, island_id
from setwise.session import cut

LABEL = "start_end_excercise_id"
SESSION = ("filename", "measure_date")
SPANS = ("concentric_time", "eccentric_time", "rest_time")


def smooth_class(
    df: DataFrame, axis: Axis, code: str, out: str, before: int = SMOOTHING_ROWS, after: int = SMOOTHING_ROWS
) -> DataFrame:
    """Fill short drop-outs of the predicted class by a centred rolling maximum."""
    return rolling_max(df, axis, F.col(code), out, before, after)


def movement(label: str = LABEL, concentric: str = "concentric", eccentric: str = "eccentric") -> Column:
    """1 inside a named set while the lifter moves one way, not both and not none."""
    one_way = F.col(concentric).cast("int").bitwiseXOR(F.col(eccentric).cast("int")) == 1
    return F.when((F.col(label) != UNKNOWN) & one_way, 1).otherwise(0)


def time_markers(df: DataFrame, time: str = "time_vector", rest_rule: str = "both_zero") -> DataFrame:
    """Add the sample time once per kind of phase, for later spans.

    Rest means neither way. ``rest_rule='legacy'`` counts a sample as rest unless it
    moves both ways and writes 0 instead of null.
    """
    t, up, down = F.col(time), F.col("concentric"), F.col("eccentric")
    if rest_rule == "legacy":
        rest = F.when((down == 0) | (up == 0), t).otherwise(0.0)
    elif rest_rule == "both_zero":
        rest = F.when((down == 0) & (up == 0), t)
    else:
        raise ValueError(f"unknown rest_rule: {rest_rule}")
    return df.withColumns(
        {"concentric_time": F.when(up == 1, t), "eccentric_time": F.when(down == 1, t), "rest_time": rest}
    )


def mark_phases(
    df: DataFrame, axis: Axis, code: str = LABEL, rest_rule: str = "both_zero", legacy: bool = False,
    before: int = SMOOTHING_ROWS, after: int = SMOOTHING_ROWS,
) -> DataFrame:
    """Smooth and name the predicted class, number the movement runs, add the markers."""
    if axis.chunk is not None and not legacy:  # the old run ids count rows, so they need all of them
        rows = axis.split(df)
        runs = numbered_runs(stretches(rows, axis, code, rest_rule, before, after), axis)
        labels = runs.select(*axis.cell, "__first.*", LABEL, "events", F.col("__run").alias("events_groups"))
        taken = {LABEL, code, "events", "events_groups"}
        df = hold_labels(rows.drop(*taken), labels, axis).drop(CHUNK)
        return time_markers(df, axis.time, rest_rule)
    return _mark_rows(df, axis, code, rest_rule, legacy, before, after)


@ordered
def _mark_rows(df: DataFrame, axis: Axis, code: str, rest_rule: str, legacy: bool, before: int, after: int) -> DataFrame:
    df = smooth_class(df, axis, code, "__smooth", before, after)
    df = df.withColumn(LABEL, class_name("__smooth")).drop("__smooth")
    df = island_id(df.withColumn("events", movement()), axis, "events", "events_groups", legacy)
    return time_markers(df, axis.time, rest_rule)


def _bounds(spans: Sequence[str] = SPANS) -> list[str]:
    return [f"__{end}_{c}" for c in spans for end in ("min", "max")]


def stretches(
    df: DataFrame, axis: Axis, code: str = LABEL, rest_rule: str = "both_zero", before: int = SMOOTHING_ROWS,
    after: int = SMOOTHING_ROWS, extra: Sequence[str] = (),
) -> DataFrame:
    """The rows of each chunk as stretches of one label and one state of movement: their
    place in the chunk (``__row``), the order columns of their first row (``__first``), label,
    ``events``, and least and largest time of each kind of phase. One shuffle of the few
    columns that matter; ``extra`` columns are kept apart as well.

    Smoothing looks beyond the chunk for the rows near its borders only: these stay rows of
    their own until they are put in order by session.
    """
    names = list(dict.fromkeys([*axis.keys, *axis.order, *extra, code, "concentric", "eccentric"]))
    rows = time_markers(axis.split(df.select(*names, *[c for c in (CHUNK,) if c in df.columns])), axis.time, rest_rule)
    rows = numbered(rows.withColumn("__code", F.col(code)), axis)
    rows = rows.withColumns(
        {"__near": near_border(before, after), "__smooth": F.max("__code").over(axis.rows().rowsBetween(-before, after))}
    )
    rows = rows.withColumn(LABEL, class_name("__smooth")).withColumn("events", movement())
    state = F.struct("__near", LABEL, "events", *extra)
    starts = F.col("__near") | ~state.eqNullSafe(F.lag(state).over(axis.rows()))
    rows = rows.withColumn("__starts", starts).withColumn("__stretch", F.sum(F.col("__starts").cast("long")).over(axis.so_far()))
    ends = [f(c).alias(f"__{f.__name__}_{c}") for c in SPANS for f in (F.min, F.max)]
    # Of one row each where the smoothing is not settled, so that any value is that row's.
    single = [F.min(c).alias(c) for c in ("__row", "__rows", "__code", "__smooth", "concentric", "eccentric", "events")]
    found = rows.groupBy(*axis.cell, *extra, "__stretch", "__near", LABEL).agg(
        *single, F.min(F.struct(*axis.order)).alias("__first"), *ends
    )
    found = cut(found.drop("__stretch"))
    settled = found.where("NOT __near")
    open_ = found.where("__near").withColumn("__beyond", beyond_border(axis, "__code", before, after))
    open_ = open_.withColumn(LABEL, class_name(F.greatest("__smooth", "__beyond"))).withColumn("events", movement())
    kept = [*axis.cell, *extra, "__row", "__first", LABEL, "events", *_bounds()]
    return settled.select(*kept).unionByName(open_.select(*kept))


def numbered_runs(found: DataFrame, axis: Axis, extra: Sequence[str] = ()) -> DataFrame:
    """Stretches of a chunk with one run of movement and one label put together, with the
    number of the run in its session (``__run``).

    A chunk counts its runs; the first of them goes on from the chunk before if the state is
    the same.
    """
    w = Window.partitionBy(*axis.cell).orderBy("__row")
    first = F.lag(F.lit(1)).over(w).isNull()
    changed = first | ~F.col("events").eqNullSafe(F.lag("events").over(w))
    found = found.withColumn("__changed", changed).withColumn("__own", F.sum(F.col("__changed").cast("long")).over(w))
    ends = [(F.min if c.startswith("__min") else F.max)(c).alias(c) for c in (*_bounds(), "events")]
    state = F.min("__first").alias("__first")
    # Stretches stay apart where they are not neighbours, as rows take their label from them.
    apart = ~F.struct("events", LABEL, *extra).eqNullSafe(F.lag(F.struct("events", LABEL, *extra)).over(w))
    found = found.withColumn("__apart", apart).withColumn("__part", F.sum(F.col("__apart").cast("long")).over(w))
    runs = cut(found.groupBy(*axis.cell, *extra, "__own", "__part", LABEL).agg(*ends, state))
    heads = runs.groupBy(*axis.cell).agg(
        F.max("__own").alias("__n"), F.min_by("events", "__own").alias("__head"), F.max_by("events", "__own").alias("__tail")
    )
    chunks = Window.partitionBy(*axis.keys).orderBy(CHUNK)
    goes_on = F.lag(F.lit(1)).over(chunks).isNotNull() & F.col("__head").eqNullSafe(F.lag("__tail").over(chunks))
    heads = heads.withColumn("__goes_on", F.coalesce(goes_on, F.lit(False)).cast("long"))
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.sum("__goes_on").over(chunks)
    offsets = heads.select(*axis.cell, carried.alias("__carried"))
    numbered = runs.join(offsets, axis.cell).withColumn("__run", F.col("__own") + F.col("__carried"))
    return numbered.drop("__own", "__part", "__carried")


def phases_of(
    df: DataFrame, axis: Axis, session: Sequence[str] = SESSION, code: str = LABEL, rest_rule: str = "both_zero",
    before: int = SMOOTHING_ROWS, after: int = SMOOTHING_ROWS,
) -> DataFrame:
    """The ``phase_table`` of rows with predictions, without marking the rows on a chunked axis."""
    if axis.chunk is None:
        return phase_table(mark_phases(df, axis, code, rest_rule, False, before, after), session, axis.time)
    extra = [c for c in session if c not in axis.keys]
    runs = numbered_runs(stretches(df, axis, code, rest_rule, before, after, extra), axis, extra)
    spans = [(F.max(f"__max_{c}") - F.min(f"__min_{c}")).alias(c) for c in SPANS]
    return runs.groupBy(*session, F.col("__run").alias("events_groups"), LABEL).agg(
        *spans, F.min(f"__first.{axis.time}").alias("phase_start")
    )


def phase_table(df: DataFrame, session: Sequence[str] = SESSION, time: str = "time_vector") -> DataFrame:
    """One row per movement run and label: its spans and its start.

    Only minima and maxima, so each task reduces its rows before the shuffle.
    """
    return df.groupBy(*session, "events_groups", LABEL).agg(
        *[(F.max(c) - F.min(c)).alias(c) for c in SPANS], F.min(time).alias("phase_start")
    )


def set_ids(phases: DataFrame, axis: Axis) -> DataFrame:
    """Number the stretches of consecutive phases with and without a known exercise."""
    known = (F.col(LABEL) != UNKNOWN).cast("int")
    return island_id(phases.withColumn("known", known), axis, "known", "group_id").drop("known")


def phase_axis(chunk: float | None = None) -> Axis:
    """Phases of a session in order of time. The file name alone is the key: the date
    follows from it and may be null."""
    return Axis(("filename",), "phase_start", ("events_groups", LABEL), chunk)


def session_summary(phases: DataFrame, session: Sequence[str] = SESSION) -> DataFrame:
    """Sets, exercise, repetitions and times per session."""
    sets = F.countDistinct(F.when(F.col(LABEL) != UNKNOWN, F.col("group_id"))).alias("sets")
    return phases.groupBy(*session).agg(*_totals(sets))


def _totals(sets: Column) -> list[Column]:
    known = F.col(LABEL) != UNKNOWN
    up, down = F.count_if(F.col("concentric_time") > 0), F.count_if(F.col("eccentric_time") > 0)
    return [
        F.coalesce(F.mode(F.when(known, F.col(LABEL)), deterministic=True), F.lit(UNKNOWN)).alias("excercise"),
        sets,
        ((up + down) / 2).alias("reps"),
        *[F.sum(c).alias(f"total_{c}") for c in SPANS],
        *[F.avg(c).alias(f"avg_{c}") for c in SPANS],
        up.alias("count_concentric_times"),
        down.alias("count_eccentric_times"),
    ]


def summarise_phases(phases: DataFrame, axis: Axis, session: Sequence[str] = SESSION) -> DataFrame:
    """The ``session_summary`` of a phase table, with its sets.

    On a chunked axis a set counts where it begins: at a phase with a known exercise after one
    without. Chunks count theirs, and whether the first phase of a chunk begins a set depends
    on the last one of the chunk before.
    """
    order = phase_axis(axis.chunk)
    if axis.chunk is None:
        return session_summary(set_ids(phases, order), session)
    phases = cut(phases)  # a long session may also have many phases
    known = F.col(LABEL) != UNKNOWN
    w = order.rows()
    marks = order.split(phases).select(*order.cell, *order.order)
    marks = marks.withColumns({"__known": known, "__after": F.lag(known).over(w)})
    heads = marks.groupBy(*order.cell).agg(
        F.count_if(F.col("__known") & ~F.col("__after")).alias("__begun"),
        F.min_by("__known", order.place()).alias("__head"),
        F.max_by("__known", order.place()).alias("__tail"),
    )
    before = F.lag("__tail").over(Window.partitionBy(*order.keys).orderBy(CHUNK))
    heads = heads.withColumn("__begun", F.col("__begun") + (F.col("__head") & ~F.coalesce(before, F.lit(False))).cast("long"))
    sets = heads.groupBy(*order.keys).agg(F.sum("__begun").alias("__sets"))
    totals = phases.groupBy(*session).agg(*_totals(F.lit(None).cast("long").alias("sets")))
    return totals.join(sets, list(order.keys)).withColumn("sets", F.col("__sets")).drop("__sets").select(*totals.columns)


def plot_traces(
    df: DataFrame, prefix: str, color: str = "events_groups", offset: Sequence[float] = WRIST_OFFSET,
    period_ms: int | None = None,
) -> DataFrame:
    """Long table ``(sensor, x, y, z, color)`` of one channel group, for plotting.

    The wrist trace is moved aside by ``offset``.
    """
    if period_ms:
        df = downsample(df, period_ms)
    chest = [F.col(f"{prefix}{a}_cs") for a in "XYZ"]
    wrist = [F.col(f"{prefix}{a}_ws") + F.lit(float(d)) for a, d in zip("XYZ", offset)]
    trace = [
        F.struct(F.lit(name).alias("sensor"), *[v.alias(a) for a, v in zip("xyz", values)])
        for name, values in (("chest", chest), ("wrist", wrist))
    ]
    return df.select(F.inline(F.array(*trace)), F.col(color).alias("color"))
