"""Calendar, supply-demand and interaction features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from pricegrid.schemas import EVENING_PEAK, HOLIDAYS, MORNING_PEAK


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Append columns given as SQL text, replacing those that exist."""
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    return df.selectExpr(*kept, *[f"{text} AS `{name}`" for name, text in columns.items()])


def calendar_columns(ts_col: str = "ts", zone: str | None = None) -> dict[str, str]:
    ts = f"`{ts_col}`" if zone is None else f"from_utc_timestamp(`{ts_col}`, '{zone}')"
    full = repr(2 * math.pi) + "D"
    holidays = ", ".join(f"'{day}'" for day in HOLIDAYS)

    def between(bounds: tuple[int, int]) -> str:
        return f"CAST(hour({ts}) BETWEEN {bounds[0]} AND {bounds[1]} AS INT)"

    return {
        "hour": f"hour({ts})",
        "day_of_week": f"weekday({ts})",
        "month": f"month({ts})",
        "day_of_year": f"dayofyear({ts})",
        "week_of_year": f"weekofyear({ts})",
        "is_weekend": f"CAST(weekday({ts}) >= 5 AS INT)",
        "is_holiday": f"CAST(date_format({ts}, 'MM-dd') IN ({holidays}) AS INT)",
        "hour_sin": f"sin({full} * hour({ts}) / 24)",
        "hour_cos": f"cos({full} * hour({ts}) / 24)",
        "month_sin": f"sin({full} * month({ts}) / 12)",
        "month_cos": f"cos({full} * month({ts}) / 12)",
        "is_peak_morning": between(MORNING_PEAK),
        "is_peak_evening": between(EVENING_PEAK),
    }


def time_features(df: DataFrame, ts_col: str = "ts", zone: str | None = None) -> DataFrame:
    """Add the 13 calendar features, read in UTC or in ``zone``."""
    return _add(df, calendar_columns(ts_col, zone))


def market_columns() -> dict[str, str]:
    residual = "(load_forecast - wind_forecast - solar_forecast)"
    renewable = "(wind_forecast + solar_forecast)"
    ratio = f"try_divide({renewable}, load_forecast)"
    return {
        "residual_load": residual,
        # Zero load: the unbounded ratio is clipped to 1, and 0/0 is missing.
        "renewable_ratio": (
            f"CASE WHEN load_forecast = 0 THEN CASE WHEN {renewable} > 0 THEN 1.0D "
            f"WHEN {renewable} < 0 THEN 0.0D END "
            f"WHEN {ratio} > 1 THEN 1.0D WHEN {ratio} < 0 THEN 0.0D ELSE {ratio} END"
        ),
        "renewable_surplus": f"CASE WHEN {residual} < 0 THEN -{residual} ELSE 0.0D END",
        "load_stress": f"try_divide({residual}, load_forecast)",
    }


def market_features(df: DataFrame) -> DataFrame:
    """Add residual load, renewable share, surplus and load stress."""
    if not {"load_forecast", "wind_forecast", "solar_forecast"} <= set(df.columns):
        return df
    return _add(df, market_columns())


def interaction_features(df: DataFrame) -> DataFrame:
    """Add the products for which both inputs are present."""
    have = set(df.columns)
    out: dict[str, str] = {}
    if {"temperature_avg", "load_forecast"} <= have:
        out["temp_load_interaction"] = "temperature_avg * load_forecast"
    if {"wind_speed_80m_avg", "wind_forecast"} <= have:
        speed = "wind_speed_80m_avg"
        out["wind_efficiency"] = (
            f"CASE WHEN {speed} > 0 THEN try_divide(wind_forecast, {speed} * {speed} * {speed}) "
            "ELSE 0.0D END"
        )
    if {"hour", "load_forecast"} <= have:
        out["hour_load_interaction"] = "hour * load_forecast"
    return _add(df, out) if out else df
