"""The feature job: calendar, market, lag and interaction blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.features import interaction_features, market_features, time_features
from pricegrid.operators.chunks import CHUNK_HOURS
from pricegrid.operators.grid import axis_partitions, hourly_grid
from pricegrid.operators.lags import lag_features
from pricegrid.schemas import LAGS, ROLLING, SERIES, TS


def engineer(
    df: DataFrame,
    include_lag: bool = True,
    series_cols: Sequence[str] = (SERIES,),
    ts_col: str = TS,
    calendar_tz: str | None = None,
    regular: bool = True,
    chunk_hours: int = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """Add all feature blocks whose inputs are present."""
    out = market_features(time_features(df, ts_col, calendar_tz))
    if include_lag and "price" in df.columns:
        out = lag_features(
            out, "price", series_cols=series_cols, ts_col=ts_col, regular=regular,
            chunk_hours=chunk_hours, parts=parts,
        )
    return interaction_features(out)


def engineer_on_grid(
    df: DataFrame,
    series_cols: Sequence[str] = (SERIES,),
    ts_col: str = TS,
    parts: int | None = None,
    **options,
) -> DataFrame:
    """``engineer`` for rows whose hours may have holes.

    Lags and frames count hours: the rows are put on the gap-free hourly axis of their
    series first, and only rows that were there come back. A missing hour gives null
    lags and frames without statistics, whatever the chunk size. Rows off the axis of
    full steps from a series' first instant are dropped. The number of partitions follows
    the hours of all axes, which one aggregate counts unless ``parts`` is given.
    """
    if parts is None:
        parts = axis_partitions(df, series_cols, ts_col)
    marked = df.withColumn("__there", F.lit(True))
    grid = hourly_grid(marked, series_cols, ts_col=ts_col, parts=parts)
    done = engineer(grid, series_cols=series_cols, ts_col=ts_col, regular=True, parts=parts, **options)
    return done.where("__there").drop("__there")


def lookback_hours() -> int:
    """History needed before the first row of interest."""
    return max([*LAGS, *ROLLING])


def engineer_range(
    df: DataFrame, start, end, ts_col: str = TS, on_grid: bool = False, **options
) -> DataFrame:
    """Features of ``[start, end]`` from rows that reach back far enough.

    A cut on time does not move below a window, so the input is cut with the
    lookback first and the result is cut to the range. ``on_grid`` is for history
    whose hours may have holes.
    """
    first = F.lit(start).cast("timestamp")
    last = F.lit(end).cast("timestamp")
    reach = F.make_dt_interval(hours=F.lit(lookback_hours()))
    history = df.where((F.col(ts_col) >= first - reach) & (F.col(ts_col) <= last))
    build = engineer_on_grid if on_grid else engineer
    return build(history, ts_col=ts_col, **options).where(F.col(ts_col) >= first)
