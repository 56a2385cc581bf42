"""Tables behind the reports: summaries, profiles, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.functions.errors import error_metrics
from pricegrid.schemas import CHEAPEST, HISTOGRAM_BINS, MAE_LIMIT


def mode_label(
    df: DataFrame,
    as_of: Column,
    backtest_days: int | None = None,
    forecast_days: int | None = None,
    ts_col: str = "ts",
) -> DataFrame:
    """Mark rows before ``as_of`` as backtest and the others as forecast.

    With day limits, rows outside ``[as_of - backtest, as_of + forecast]`` go.
    """
    ts = F.col(ts_col)
    keep = F.lit(True)
    if backtest_days is not None:
        keep = keep & (ts >= as_of - F.make_dt_interval(days=F.lit(backtest_days)))
    if forecast_days is not None:
        keep = keep & (ts <= as_of + F.make_dt_interval(days=F.lit(forecast_days)))
    return df.where(keep).withColumn(
        "mode", F.when(ts < as_of, "backtest").otherwise("forecast")
    )


def mode_masks(df: DataFrame, price_col: str = "predicted_price") -> DataFrame:
    """One price column per mode, null in rows of the other mode."""
    return df.withColumns(
        {
            f"{mode}_price": F.when(F.col("mode") == mode, F.col(price_col))
            for mode in ("backtest", "forecast")
        }
    )


def display_subset(df: DataFrame) -> DataFrame:
    """Forecast rows if there are any, otherwise all rows."""
    if "mode" not in df.columns:
        return df
    forecasts = df.agg(F.count_if(F.col("mode") == "forecast").alias("n")).scalar()
    return df.where((F.col("mode") == "forecast") | (forecasts == 0))


def detail_table(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Rows for display, in time order, price with two decimals.

    Halves of the decimal form round away from zero.
    """
    cols = [
        F.date_format(ts_col, "yyyy-MM-dd HH:mm").alias("timestamp"),
        F.round("predicted_price", 2).alias("predicted_price"),
    ]
    cols += [F.col(c) for c in ("mode", "actual_price") if c in df.columns]
    return df.orderBy(ts_col).select(*cols)


def metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts and error measures, per group if ``by`` is given."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("actual_price").alias("scored_rows"),
        *error_metrics(),
    )


def score_summary(df: DataFrame, by: Sequence[str] = (), ts_col: str = "ts") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(ts_col).alias("first_ts"),
        F.max(ts_col).alias("last_ts"),
        F.avg("predicted_price").alias("avg_price"),
        F.min("predicted_price").alias("min_price"),
        F.max("predicted_price").alias("max_price"),
        F.avg("abs_error").alias("mae"),
    )


def value_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, min_value, max_value`` of each column."""
    row = df.agg(*[a(c).alias(f"{n}_{c}") for c in cols for a, n in ((F.min, "lo"), (F.max, "hi"))])
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"lo_{c}").alias("min_value"),
            F.col(f"hi_{c}").alias("max_value"),
        )
        for c in cols
    ]
    return row.select(F.inline(F.array(*parts)))


def dashboard_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, extremes, their distance to the mean, and the error where known."""
    known = F.when(F.col("actual_price").isNotNull(), F.col("abs_error"))
    return (
        df.groupBy(*by)
        .agg(
            F.avg("predicted_price").alias("avg_price"),
            F.min("predicted_price").alias("min_price"),
            F.max("predicted_price").alias("max_price"),
            F.avg(known).alias("mae"),
        )
        .withColumn("min_delta", F.col("min_price") - F.col("avg_price"))
        .withColumn("max_delta", F.col("max_price") - F.col("avg_price"))
    )


def mae_alert(df: DataFrame, by: Sequence[str], limit: float = MAE_LIMIT) -> DataFrame:
    """Groups whose mean absolute error exceeds the limit."""
    return df.groupBy(*by).agg(F.avg("abs_error").alias("mae")).where(F.col("mae") > limit)


def gap_alert(runs: DataFrame, limit: int) -> DataFrame:
    """Null runs longer than the limit (input from ``null_runs``)."""
    return runs.where(F.col("run_len") > limit)


def hourly_profile(
    df: DataFrame, by: Sequence[str] = (), ts_col: str = "ts", price_col: str = "predicted_price"
) -> DataFrame:
    return df.groupBy(*by, F.hour(ts_col).alias("hour")).agg(F.avg(price_col).alias("avg_price"))


def price_histogram(
    df: DataFrame, price_col: str = "predicted_price", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Counts in ``bins`` equal bins over [min, max]; the last bin is closed.

    The range is a scalar subquery, so the scan is read twice and no row leaves
    its task before counting. Empty bins are not listed.
    """
    span = df.agg(F.struct(F.min(price_col).alias("lo"), F.max(price_col).alias("hi"))).scalar()
    # least() skips nulls, so a range of zero width is sent to the first bin here
    place = f"floor(coalesce(try_divide(`{price_col}` - __lo, __width), 0.0D))"
    return (
        df.where(F.col(price_col).isNotNull())
        .select(price_col, span.alias("__span"))
        .selectExpr(
            f"`{price_col}`", "__span.lo AS __lo", f"(__span.hi - __span.lo) / {bins} AS __width"
        )
        .selectExpr(f"CAST(least({place}, {bins - 1}) AS INT) AS bin", "__lo", "__width")
        .groupBy("bin", "__lo", "__width")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .selectExpr(
            "bin",
            "__lo + bin * __width AS bin_low",
            "__lo + (bin + 1) * __width AS bin_high",
            "row_count",
        )
    )


def heatmap(
    df: DataFrame, ts_col: str = "ts", price_col: str = "predicted_price", by: Sequence[str] = ()
) -> DataFrame:
    """Dates by hours ``h00 .. h23``; (date, hour) must be unique."""
    hour = F.hour(ts_col)
    return df.groupBy(*by, F.to_date(ts_col).alias("date")).agg(
        *[F.max(F.when(hour == h, F.col(price_col))).alias(f"h{h:02d}") for h in range(24)]
    )


def duplicate_cells(df: DataFrame, ts_col: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """(date, hour) cells with more than one row, which a heatmap cannot show."""
    return (
        df.groupBy(*by, F.to_date(ts_col).alias("date"), F.hour(ts_col).alias("hour"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def cheapest_hours(
    df: DataFrame, n: int = CHEAPEST, price_col: str = "predicted_price", ts_col: str = "ts"
) -> DataFrame:
    """The ``n`` cheapest rows overall, earlier rows first on equal price."""
    return df.where(F.col(price_col).isNotNull()).orderBy(price_col, ts_col).limit(n)


def cheapest_hours_window(
    df: DataFrame,
    as_of: Column,
    hours: int = 24,
    n: int = CHEAPEST,
    price_col: str = "predicted_price",
    ts_col: str = "ts",
) -> DataFrame:
    """The cheapest rows of the next hours, or of all rows if there are too few."""
    until = as_of + F.make_dt_interval(hours=F.lit(hours))
    inside = F.col(ts_col).between(as_of, until)
    found = df.agg(F.count_if(inside).alias("n")).scalar()
    return cheapest_hours(df.where(inside | (found < n)), n, price_col, ts_col)


def cheapest_hours_per_day(
    df: DataFrame,
    n: int = CHEAPEST,
    price_col: str = "predicted_price",
    ts_col: str = "ts",
    by: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` cheapest rows of each day with their rank.

    The rank filter is applied per task before the shuffle as well, so a day
    never gathers more than ``n`` rows per task.
    """
    day = Window.partitionBy(*by, "date").orderBy(price_col, ts_col)
    return (
        df.where(F.col(price_col).isNotNull())
        .withColumn("date", F.to_date(ts_col))
        .withColumn("price_rank", F.row_number().over(day))
        .where(F.col("price_rank") <= n)
    )
