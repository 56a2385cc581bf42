"""Joins of market tables and sums over generation types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.schemas import MARKET_COLS, SERIES, SOLAR_TYPES, TS, WEATHER_COLS, WIND_TYPES


def generation_by_type(
    points: DataFrame,
    keys: Sequence[str] = (SERIES, TS),
    type_col: str = "psr_type",
    value_col: str = "quantity",
    wind_types: Sequence[str] = tuple(WIND_TYPES),
    solar_types: Sequence[str] = tuple(SOLAR_TYPES),
) -> DataFrame:
    """Wind and solar sums per instant, 0 where one of them is absent.

    One aggregate over both kinds; instants of either kind appear, so no outer
    join of the two is needed. Other types are filtered out before the shuffle.
    """

    def total(types: Sequence[str]) -> Column:
        picked = F.when(F.col(type_col).isin(list(types)), F.col(value_col))
        return F.coalesce(F.sum(picked), F.lit(0)).cast("double")

    return (
        points.where(F.col(type_col).isin([*wind_types, *solar_types]))
        .groupBy(*keys)
        .agg(
            total(wind_types).alias("wind_forecast"),
            total(solar_types).alias("solar_forecast"),
        )
    )


def join_market(
    price: DataFrame,
    load: DataFrame,
    generation: DataFrame,
    keys: Sequence[str] = (SERIES, TS),
) -> DataFrame:
    """Price rows with load and generation of the same instant, if present.

    All three sides are hashed on the same keys, so each is exchanged once.
    """
    return price.join(load, list(keys), "left").join(generation, list(keys), "left")


def join_weather(
    market: DataFrame, weather: DataFrame, keys: Sequence[str] = (SERIES, TS), how: str = "left"
) -> DataFrame:
    return market.join(weather, list(keys), how)


def split_columns(
    merged: DataFrame, keys: Sequence[str] = (SERIES, TS)
) -> tuple[DataFrame, DataFrame]:
    """Market and weather column sets of a merged table."""
    return merged.select(*keys, *MARKET_COLS), merged.select(*keys, *WEATHER_COLS)


def row_mean(cols: Sequence[str]) -> Column:
    """Mean over columns of one row, ignoring nulls."""
    present = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.try_divide(total, present)


def wide_load(df: DataFrame, keys: Sequence[str] = (SERIES, TS)) -> DataFrame:
    """Load from a wide table: the only column as is, several as row mean."""
    cols = [c for c in df.columns if c not in keys]
    value = F.col(cols[0]) if len(cols) == 1 else row_mean(cols)
    return df.select(*keys, value.alias("load_forecast"))


def wide_generation(df: DataFrame, keys: Sequence[str] = (SERIES, TS)) -> DataFrame:
    """Wind and solar from a wide table whose columns are found by name.

    All columns containing "wind" are added (a null makes the sum null). Solar
    is the column ``Solar``; failing that, if some column equals "solar" in any
    case, the first one containing it; failing that 0.
    """
    names = [c for c in df.columns if c not in keys]
    wind = [F.col(f"`{c}`") for c in names if "wind" in c.lower()]
    total = sum(wind[1:], wind[0]) if wind else F.lit(0.0)
    if "Solar" in names:
        solar = F.col("Solar")
    elif "solar" in [c.lower() for c in names]:
        solar = F.col(f"`{next(c for c in names if 'solar' in c.lower())}`")
    else:
        solar = F.lit(0.0)
    return df.select(
        *keys,
        total.cast("double").alias("wind_forecast"),
        solar.cast("double").alias("solar_forecast"),
    )
