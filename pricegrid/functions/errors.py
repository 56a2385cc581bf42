"""Forecast error measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def error_columns(actual: str = "actual_price", predicted: str = "predicted_price") -> dict:
    error = F.col(actual) - F.col(predicted)
    return {"error": error, "abs_error": F.abs(error)}


def error_metrics(actual: str = "actual_price", predicted: str = "predicted_price") -> list[Column]:
    """``mae, rmse, r2, mape`` over rows where both values are known.

    ``r2`` is one minus the ratio of squared error to the spread of the actual
    values; without any spread it is 1 for a perfect forecast, else 0. ``mape``
    divides by the actual value, at least 1e-8, so it explodes at prices of
    zero and below.
    """
    known = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    y = F.when(known, F.col(actual))
    e = F.when(known, F.col(actual) - F.col(predicted))
    squared = F.sum(e * e)
    spread = F.var_pop(y) * F.count(y)
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(spread == 0, F.when(squared == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(squared, spread))
        .alias("r2"),
        (F.avg(F.abs(e) / F.greatest(y, F.lit(1e-8))) * 100).alias("mape"),
    ]
