"""Projection, cleaning, resampling and routing of samples. All row-local."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setwise.functions.scalars import ticks_10ms

_FRACTIONS = ("float", "double")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job starts if a needed column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def select_renamed(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Keep the columns named in ``renames`` and give them their new names."""
    return require_columns(df, renames).select(*renames).withColumnsRenamed(dict(renames))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = set(names)
    return df.select(*[c for c in df.columns if c not in names])


def infinite_to_nan(df: DataFrame) -> DataFrame:
    """Replace infinities in all fractional columns by NaN, in one projection."""
    bounds = [F.lit(float("inf")), F.lit(float("-inf"))]
    nan = F.lit(float("nan"))
    return df.withColumns(
        {
            name: F.when(F.col(name).isin(*bounds), nan.cast(kind)).otherwise(F.col(name))
            for name, kind in df.dtypes
            if kind in _FRACTIONS
        }
    )


def clean_samples(df: DataFrame, zero_is_missing: Iterable[str] = ()) -> DataFrame:
    """Keep the rows in which every column has a finite value and none of
    ``zero_is_missing`` is exactly zero.

    Rows that stay need no change, so this is one filter over the scanned columns.
    """
    infinity = F.lit(float("inf"))
    # NaN sorts above infinity and a null makes the comparison unknown.
    usable = [
        F.abs(F.col(name)) < infinity if kind in _FRACTIONS else F.col(name).isNotNull() for name, kind in df.dtypes
    ]
    usable += [F.col(name) != 0 for name in zero_is_missing]
    return df.where(functools.reduce(Column.__and__, usable))


def raster_columns(df: DataFrame, time: str = "time_vector") -> DataFrame:
    """Add the whole second, the 100 ms and 10 ms floors and their remainders."""
    ticks = ticks_10ms(time)
    return df.withColumns(
        {
            "time_sec": F.floor(ticks / 100),
            "time_100ms": F.floor(ticks / 10) / 10,
            "time_10ms": ticks / 100,
            "dec_100ms": F.floor(F.pmod(ticks, F.lit(100)) / 10) / 10,
            "dec_10ms": F.pmod(ticks, F.lit(10)) / 100,
        }
    )


def downsample(df: DataFrame, period_ms: int, time: str = "time_vector") -> DataFrame:
    """Keep the samples that lie on a raster of ``period_ms`` (a multiple of 10)."""
    if period_ms <= 0 or period_ms % 10:
        raise ValueError("period_ms must be a positive multiple of 10")
    return df.where(ticks_10ms(time) % (period_ms // 10) == 0)


def resample_where(df: DataFrame, condition: Column | None) -> DataFrame:
    """Keep the rows of a caller's condition on the raster columns; None keeps all."""
    if condition is None:
        return df
    added = ["time_sec", "time_100ms", "time_10ms", "dec_100ms", "dec_10ms"]
    return raster_columns(df).where(condition).drop(*added)


def route(df: DataFrame, code: str = "excercise_id") -> tuple[DataFrame, DataFrame]:
    """Split into labelled (code other than 0) and unlabelled rows."""
    return df.where(F.col(code) != 0), df.where(F.col(code) == 0)
