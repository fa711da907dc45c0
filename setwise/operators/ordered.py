"""Ordered scans over sessions: the primitives below every signal operator.

A session is normally small (one recording), so a plain window per session is the
best plan: one exchange on the session key, one sort, many window expressions.
``fit_axis`` measures that. If one session is too large for a single task, it
returns an axis with a chunk length, and the same primitives work in two steps:

1. windows inside (session, chunk), which spreads a session over many tasks;
2. one summary row per (session, chunk), built with map-side aggregation, scanned
   per session and joined back, which carries values over the chunk borders.

Results are the same either way. Session keys and the time column must not be null, which
``fit_axis`` checks at any size.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from setwise.session import cut

CHUNK = "__chunk"
MAX_ROWS = 2_000_000
"""Rows of one session that a single task may sort and scan."""

FINE_STEPS = 64
"""Parts of a chunk in which rows are counted to fit its length."""

Reduce = tuple[str, Column]
"""An aggregate that can be applied to its own results: ('max' | 'min', value)."""

_REDUCERS: dict[str, Callable[[Column], Column]] = {"max": F.max, "min": F.min}


@dataclass(frozen=True)
class Axis:
    """How rows form sessions and how they are ordered inside one.

    ``ties`` makes the order total; ``chunk`` is a length in units of ``time``.
    """

    keys: tuple[str, ...]
    time: str
    ties: tuple[str, ...] = ()
    chunk: float | None = None

    @property
    def order(self) -> list[str]:
        return [self.time, *self.ties]

    @property
    def cell(self) -> list[str]:
        """The columns one task works on."""
        return [*self.keys] if self.chunk is None else [*self.keys, CHUNK]

    def rows(self) -> WindowSpec:
        return Window.partitionBy(*self.cell).orderBy(*self.order)

    def so_far(self) -> WindowSpec:
        return self.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def everything(self) -> WindowSpec:
        return Window.partitionBy(*self.cell)

    def place(self) -> Column:
        """A value that sorts like the row order."""
        return F.struct(*self.order) if self.ties else F.col(self.time)

    def split(self, df: DataFrame) -> DataFrame:
        if self.chunk is None or CHUNK in df.columns:
            return df
        return df.withColumn(CHUNK, F.floor(F.col(self.time) / F.lit(self.chunk)))


def fit_axis(
    df: DataFrame,
    keys: tuple[str, ...],
    time: str,
    ties: tuple[str, ...] = (),
    max_rows: int = MAX_ROWS,
) -> Axis:
    """Measure the sessions of ``df`` and choose whether, and how finely, to chunk.

    Reads only the key and time columns, aggregates before shuffling and brings one
    row to the driver per pass. A second pass runs only if some session is too large:
    it counts the rows of heavy sessions in fine steps of time, and one more pass checks
    the chunk length that follows from the fullest step. Rows that share one instant of
    one session cannot be separated by time and stay together.
    """
    axis = Axis(tuple(keys), time, tuple(ties))
    n = F.count(F.lit(1))
    sizes = df.groupBy(*keys).agg(
        n.alias("n"),
        F.try_divide(n, F.max(time) - F.min(time)).alias("density"),
        (F.count(time) < n).alias("untimed"),
    )
    unkeyed = functools.reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    largest, densest, unusable = sizes.agg(
        F.max("n"),
        F.max(F.when(F.col("n") > max_rows, F.col("density"))),
        F.bool_or(unkeyed | F.col("untimed")),
    ).first()
    if unusable:
        raise ValueError(f"null in {', '.join(keys)} or {time}: such rows cannot be put in order")
    if largest is None or largest <= max_rows or not densest:
        return axis
    step = max_rows / densest
    while True:
        # Each chunk of ``step`` in fine steps: the fullest one bounds every chunk made of them.
        fine = replace(axis, chunk=step / FINE_STEPS)
        parts = fine.split(df).groupBy(*fine.cell).agg(n.alias("n"), F.max(time).alias("until"), F.min(time).alias("since"))
        fullest, divisible = parts.agg(F.max("n"), F.max(F.when(F.col("n") > max_rows, F.col("until") - F.col("since")))).first()
        if fullest <= max_rows or not divisible:
            return replace(axis, chunk=fine.chunk * max(1, min(FINE_STEPS, max_rows // fullest)))
        step = min(fine.chunk, divisible)


def ordered(op):
    """Give ``op(df, axis, ...)`` the chunk column it needs and take it away after."""

    @functools.wraps(op)
    def run(df: DataFrame, axis: Axis, *args, **kwargs) -> DataFrame:
        if axis.chunk is None or CHUNK in df.columns:
            return op(df, axis, *args, **kwargs)
        return op(axis.split(df), axis, *args, **kwargs).drop(CHUNK)

    return run


@ordered
def neighbours(
    df: DataFrame,
    axis: Axis,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add values of the previous (``lag``) and next (``lead``) row of the session."""
    lag, lead = dict(lag or {}), dict(lead or {})
    w = axis.rows()
    found = {out: F.lag(value).over(w) for out, value in lag.items()}
    found |= {out: F.lead(value).over(w) for out, value in lead.items()}
    if axis.chunk is None:
        return df.withColumns(found)
    place, chunks = axis.place(), Window.partitionBy(*axis.keys).orderBy(CHUNK)
    edges = [F.max_by(value, place).alias(out) for out, value in lag.items()]
    edges += [F.min_by(value, place).alias(out) for out, value in lead.items()]
    border = df.groupBy(*axis.cell).agg(*edges).select(
        *axis.cell,
        *[F.lag(out).over(chunks).alias(f"__before_{out}") for out in lag],
        *[F.lead(out).over(chunks).alias(f"__after_{out}") for out in lead],
    )
    ends = {"__first": F.lag(F.lit(1)).over(w).isNull(), "__last": F.lead(F.lit(1)).over(w).isNull()}
    joined = df.withColumns(found | ends).join(border, axis.cell, "left")
    filled = {out: F.when(F.col("__first"), F.col(f"__before_{out}")).otherwise(F.col(out)) for out in lag}
    filled |= {out: F.when(F.col("__last"), F.col(f"__after_{out}")).otherwise(F.col(out)) for out in lead}
    return joined.withColumns(filled).drop(
        *ends, *[f"__before_{out}" for out in lag], *[f"__after_{out}" for out in lead]
    )


@ordered
def cumulate(
    df: DataFrame,
    axis: Axis,
    sums: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running sums and last-known (non-null) values, the current row included."""
    sums, last = dict(sums or {}), dict(last or {})
    w = axis.so_far()
    found = {out: F.sum(value).over(w) for out, value in sums.items()}
    found |= {out: F.last(value, ignorenulls=True).over(w) for out, value in last.items()}
    if axis.chunk is None:
        return df.withColumns(found)
    earlier = (
        Window.partitionBy(*axis.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    place = axis.place()
    totals = [F.sum(value).alias(out) for out, value in sums.items()]
    totals += [F.max_by(value, F.when(value.isNotNull(), place)).alias(out) for out, value in last.items()]
    carry = df.groupBy(*axis.cell).agg(*totals).select(
        *axis.cell,
        *[F.sum(out).over(earlier).alias(f"__carry_{out}") for out in sums],
        *[F.last(out, ignorenulls=True).over(earlier).alias(f"__carry_{out}") for out in last],
    )
    joined = df.withColumns(found).join(carry, axis.cell, "left")
    filled = {out: F.coalesce(F.col(f"__carry_{out}") + F.col(out), out, f"__carry_{out}") for out in sums}
    filled |= {out: F.coalesce(out, f"__carry_{out}") for out in last}
    return joined.withColumns(filled).drop(*[f"__carry_{out}" for out in [*sums, *last]])


Step = Callable[[Column, Column, Column], Column]
"""(previous value, value, is first row of the session) -> does the row take the step?"""


@ordered
def transitions(
    df: DataFrame,
    axis: Axis,
    value: Column,
    counts: Mapping[str, Step] | None = None,
    since: Mapping[str, Step] | None = None,
) -> DataFrame:
    """Add, for steps from one value to the next, how many rows took them so far
    (``counts``) and the time of the row that did so last (``since``).

    A chunk counts the steps inside it; the step into it follows from the last value
    of the chunk before and the first value of its own.
    """
    counts, since = dict(counts or {}), dict(since or {})
    steps = counts | since
    w, so_far, time = axis.rows(), axis.so_far(), F.col(axis.time)

    def takes(step: Step, *args: Column) -> Column:
        return F.coalesce(step(*args), F.lit(False))

    found = {out: F.sum(F.col(f"__took_{out}").cast("long")).over(so_far) for out in counts}
    found |= {out: F.last(F.when(F.col(f"__took_{out}"), time), ignorenulls=True).over(so_far) for out in since}
    scratch = [f"__took_{out}" for out in steps]
    if axis.chunk is None:
        first, before = F.lag(F.lit(1)).over(w).isNull(), F.lag(value).over(w)
        took = {f"__took_{out}": takes(step, before, value, first) for out, step in steps.items()}
        return df.withColumns(took).withColumns(found).drop(*scratch)

    first, before, now = F.col("__first"), F.col("__before"), F.col("__now")
    df = df.withColumn("__now", value)
    df = df.withColumns({"__before": F.lag(now).over(w), "__first": F.lag(F.lit(1)).over(w).isNull()})
    df = df.withColumns(
        {f"__took_{out}": ~first & takes(step, before, now, F.lit(False)) for out, step in steps.items()}
    )
    took = {out: F.col(f"__took_{out}") for out in steps}
    scratch += ["__now", "__before", "__first"]
    chunks = Window.partitionBy(*axis.keys).orderBy(CHUNK)
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    inside = [F.sum(took[out].cast("long")).alias(out) for out in counts]
    inside += [F.max(F.when(took[out], time)).alias(out) for out in since]
    place = axis.place()
    ends = [F.min_by(now, place).alias("__head"), F.max_by(now, place).alias("__tail"), F.min(time).alias("__from")]
    parts = df.groupBy(*axis.cell).agg(*inside, *ends)
    parts = parts.withColumns(
        {"__tail_before": F.lag("__tail").over(chunks), "__first_chunk": F.lag(F.lit(1)).over(chunks).isNull()}
    )
    enters = {
        out: takes(step, F.col("__tail_before"), F.col("__head"), F.col("__first_chunk"))
        for out, step in steps.items()
    }
    parts = parts.withColumns({f"__enters_{out}": flag for out, flag in enters.items()})
    carried = []
    for out in counts:
        entry = F.col(f"__enters_{out}").cast("long")
        carried.append((F.coalesce(F.sum(F.col(out) + entry).over(earlier), F.lit(0)) + entry).alias(f"__carry_{out}"))
    for out in since:
        entry = F.when(F.col(f"__enters_{out}"), F.col("__from"))
        known = F.last(F.coalesce(out, entry), ignorenulls=True).over(earlier)
        carried.append(F.coalesce(entry, known).alias(f"__carry_{out}"))
    joined = df.withColumns(found).join(parts.select(*axis.cell, *carried), axis.cell, "left")
    filled = {out: F.col(out) + F.col(f"__carry_{out}") for out in counts}
    filled |= {out: F.coalesce(out, f"__carry_{out}") for out in since}
    return joined.withColumns(filled).drop(*scratch, *[f"__carry_{out}" for out in steps])


@ordered
def per_session(df: DataFrame, axis: Axis, **aggs: Reduce) -> DataFrame:
    """Add session-wide aggregates to every row."""
    if axis.chunk is None:
        return df.withColumns(
            {out: _REDUCERS[fn](value).over(axis.everything()) for out, (fn, value) in aggs.items()}
        )
    whole = Window.partitionBy(*axis.keys)
    parts = df.groupBy(*axis.cell).agg(*[_REDUCERS[fn](value).alias(out) for out, (fn, value) in aggs.items()])
    totals = parts.withColumns({out: _REDUCERS[fn](out).over(whole) for out, (fn, _) in aggs.items()})
    return df.join(totals, axis.cell, "left")


@ordered
def per_run(df: DataFrame, axis: Axis, run: str, **aggs: Reduce) -> DataFrame:
    """Add aggregates over all rows of the session with the same ``run`` id.

    A run may be as long as its session, so a chunked axis aggregates per
    (session, chunk, run) first and joins back on exactly that.
    """
    if axis.chunk is None:
        w = Window.partitionBy(*axis.keys, run)
        return df.withColumns({out: _REDUCERS[fn](value).over(w) for out, (fn, value) in aggs.items()})
    w = Window.partitionBy(*axis.keys, run)
    parts = df.groupBy(*axis.cell, run).agg(
        *[_REDUCERS[fn](value).alias(out) for out, (fn, value) in aggs.items()]
    )
    totals = parts.withColumns({out: _REDUCERS[fn](out).over(w) for out, (fn, _) in aggs.items()})
    return df.join(totals, [*axis.cell, run], "left")


@ordered
def row_numbers(df: DataFrame, axis: Axis, out: str) -> DataFrame:
    """Add the 1-based position inside the session."""
    return cumulate(df, axis, sums={out: F.lit(1)})


def near_border(before: int, after: int, row: str = "__row", rows: str = "__rows") -> Column:
    """Is a row, by its number in the chunk, so near a border that it matters to the chunks
    around, or these to it?"""
    reach = max(before, after)
    return (F.col(row) <= reach) | (F.col(row) > F.col(rows) - reach)


def numbered(df: DataFrame, axis: Axis) -> DataFrame:
    """Add ``__row`` and ``__rows``: the number of the row in its chunk and their count."""
    return df.withColumns({"__row": F.row_number().over(axis.rows()), "__rows": F.count(F.lit(1)).over(axis.everything())})


def beyond_border(axis: Axis, value: str, before: int, after: int) -> Column:
    """The maximum over the rows of other chunks that lie within reach, for rows near a
    border. Only these rows are needed, in order: the ``before`` rows ahead of one near the
    begin of its chunk are near a border too, and so are the ``after`` rows behind one near
    the end, also where chunks have fewer rows than that."""
    w = Window.partitionBy(*axis.keys).orderBy(CHUNK, "__row")
    found = [F.lit(None)]
    if before:
        found.append(F.when(F.col("__row") <= before, F.max(value).over(w.rowsBetween(-before, -1))))
    if after:
        found.append(F.when(F.col("__row") > F.col("__rows") - after, F.max(value).over(w.rowsBetween(1, after))))
    return F.greatest(*found, F.lit(None))


@ordered
def rolling_max(df: DataFrame, axis: Axis, value: Column, out: str, before: int, after: int) -> DataFrame:
    """Add the maximum over the ``before`` previous to the ``after`` next rows.

    On a chunked axis the rows are shuffled once, by chunk, and written with the maximum
    inside the chunk. The few rows near a border are put in order by session, and what they
    find beyond it comes back as one row a chunk.
    """
    frame = axis.rows().rowsBetween(-before, after)
    if axis.chunk is None or not before + after:
        return df.withColumn(out, F.max(value).over(frame))
    rows = numbered(df.withColumn("__value", value), axis)
    rows = cut(rows.withColumn(out, F.max("__value").over(frame)))
    near = near_border(before, after)
    edges = rows.where(near).select(*axis.cell, "__row", "__rows", "__value")
    edges = edges.withColumn("__beyond", beyond_border(axis, "__value", before, after))
    found = edges.groupBy(*axis.cell).agg(
        F.map_from_entries(F.collect_list(F.struct("__row", "__beyond"))).alias("__found")
    )
    joined = rows.join(found, axis.cell, "left")
    higher = F.greatest(F.col(out), F.element_at("__found", F.col("__row")))
    return joined.withColumn(out, F.when(near, higher).otherwise(F.col(out))).drop("__value", "__row", "__rows", "__found")
