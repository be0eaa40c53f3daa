"""Time filters over a record clock column.

Both bounds compare the bare column with constants, so the predicate reaches
the Parquet scan as a pushed filter (row groups skipped by min/max). Never
wrap the column in a function here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions.casts import c, day_start, end_of_day


def daily_window_predicate(ts_col: str, ds: str) -> Column:
    return (c(ts_col) >= day_start(ds)) & (c(ts_col) < end_of_day(ds))


def daily_window(df: DataFrame, ts_col: str, ds: str) -> DataFrame:
    """Records of one calendar day: ``ds 00:00 <= ts < ds+1 00:00``."""
    return df.where(daily_window_predicate(ts_col, ds))


def since_start(df: DataFrame, ts_col: str, start: str = "1970-01-01") -> DataFrame:
    """Records from ``start`` on (full extract; lower bound only)."""
    return df.where(c(ts_col) >= day_start(start))
