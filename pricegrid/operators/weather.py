"""Weighted spatial mean of weather readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

READINGS = {
    "temperature_2m": "temperature_avg",
    "wind_speed_10m": "wind_speed_10m_avg",
    "wind_speed_80m": "wind_speed_80m_avg",
    "irradiance": "irradiance_avg",
}


def normalise_weights(
    weights: DataFrame,
    group_cols: Sequence[str] = ("series_id",),
    weight_col: str = "weight",
    tolerance: float = 1e-5,
) -> DataFrame:
    """Scale weights to sum 1 per group, unless they do so already."""
    total = F.col("__total")
    sums = weights.groupBy(*group_cols).agg(F.sum(weight_col).alias("__total"))
    joined = (
        weights.join(sums, list(group_cols))
        if group_cols
        else weights.withColumn("__total", weights.agg(F.sum(weight_col)).scalar())
    )
    scaled = F.when(
        F.abs(total - 1.0) <= tolerance + 1e-8, F.col(weight_col)
    ).otherwise(F.col(weight_col) / total)
    return joined.withColumn(weight_col, scaled).select(*weights.columns)


def weighted_mean(
    readings: DataFrame,
    weights: DataFrame,
    group_cols: Sequence[str] = ("series_id", "ts"),
    location_cols: Sequence[str] = ("location",),
    values: dict[str, str] | None = None,
    weight_col: str = "weight",
    renormalise: bool = False,
) -> DataFrame:
    """Sum of value * weight over locations per instant.

    A missing reading counts as 0 and weights are not rescaled for it, unless
    ``renormalise``. The weight table is a small dimension: it is broadcast
    when its measured size is below the session's threshold, and otherwise
    joined by shuffle, where the adaptive skew join splits a hot location.
    """
    values = values or READINGS
    names = [weight_col, *location_cols]
    joined = readings.join(weights.select(*names), list(location_cols))
    weight = F.col(weight_col)
    out = []
    for source, target in values.items():
        total = F.sum(F.col(source) * weight)
        if renormalise:
            present = F.sum(F.when(F.col(source).isNotNull(), weight))
            out.append(F.try_divide(total, present).alias(target))
        else:
            out.append(F.coalesce(total, F.lit(0.0)).alias(target))
    return joined.groupBy(*group_cols).agg(*out)
