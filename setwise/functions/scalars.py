"""Column expressions for session names, times and sensor values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from setwise.contract import CLASS_NAMES, DEVICE_PATTERN, STAMP_FORMAT, STAMP_PATTERN, UNKNOWN, WALL_TIME_FORMAT

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: ColumnOrName) -> Column:
    """The part of a path after its last slash."""
    return F.substring_index(_col(path), "/", -1)


def session_stamp(name: ColumnOrName) -> Column:
    """The start stamp inside a file name, or an empty string."""
    return F.regexp_extract(_col(name), STAMP_PATTERN, 1)


def device_version(name: ColumnOrName) -> Column:
    return F.regexp_extract(_col(name), DEVICE_PATTERN, 1)


def session_start(name: ColumnOrName) -> Column:
    """The start of a session by its file name; null if the name holds no valid stamp."""
    return F.try_to_timestamp(session_stamp(name), F.lit(STAMP_FORMAT))


def wall_time(start: ColumnOrName, seconds: ColumnOrName) -> Column:
    """Time of a sample. The fraction of the start is kept."""
    micros = F.round(_col(seconds) * 1_000_000).cast("long")
    return F.timestamp_micros(F.unix_micros(_col(start)) + micros)


def wall_time_text(start: ColumnOrName, seconds: ColumnOrName) -> Column:
    """Time of a sample as text in whole seconds. The fraction of the start is ignored."""
    return F.from_unixtime((F.unix_timestamp(_col(start)) + _col(seconds)).cast("long"), WALL_TIME_FORMAT)


def ticks_10ms(seconds: ColumnOrName) -> Column:
    """Whole 10 ms steps since the start, counted in integers to avoid binary fractions."""
    return F.floor(F.round(_col(seconds) * 1000) / 10)


def button_code(start_end: ColumnOrName, peak: ColumnOrName, trough: ColumnOrName) -> Column:
    return 4 * _col(start_end) + 2 * _col(peak) + _col(trough)


def class_name(code: ColumnOrName) -> Column:
    names = [F.when(_col(code) == number, name) for number, name in CLASS_NAMES.items()]
    return F.coalesce(*names, F.lit(UNKNOWN))


def celsius(raw: ColumnOrName) -> Column:
    """Degrees Celsius from the raw value of the sensor's thermometer."""
    return _col(raw) / 340.0 + 36.53


def to_world_frame(vector: Sequence[ColumnOrName], quaternion: Sequence[ColumnOrName]) -> list[Column]:
    """Rotate ``(x, y, z)`` by the quaternion ``q = (w, x, y, z)``: q v q^-1.

    Uses v + (2w(u x v) + 2u x (u x v)) / |q|^2, with u the vector part. The length of the
    quaternion makes no difference; null if it is zero.
    """
    v = [_col(c) for c in vector]
    w, *u = [_col(c) for c in quaternion]
    turn = _cross(u, v)
    again = _cross(u, turn)
    square = w * w + u[0] * u[0] + u[1] * u[1] + u[2] * u[2]
    scale = F.when(square > 0, F.lit(2.0) / square)
    return [v[i] + scale * (w * turn[i] + again[i]) for i in range(3)]


def _cross(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
