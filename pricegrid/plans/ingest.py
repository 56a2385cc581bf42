"""From landed documents to cleaned monthly tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.functions.timezones import month_id
from pricegrid.operators.fill import ffill_bfill
from pricegrid.operators.market import join_market, join_weather, split_columns
from pricegrid.operators.weather import normalise_weights, weighted_mean
from pricegrid.plans.cleaning import clean
from pricegrid.schemas import BATCH, DISPLAY_TZ, SERIES, TS
from pricegrid.session import staged
from pricegrid.sources import documents, tables


def market_table(
    price: DataFrame,
    load: DataFrame,
    generation: DataFrame,
    prefill: bool = True,
    zone: str | None = DISPLAY_TZ,
) -> DataFrame:
    """Joined market rows per local month; ``prefill`` fills each month both ways.

    The local month is the batch of the cleaning only; tables are stored by UTC month.
    """
    joined = join_market(price, load, generation).withColumn(BATCH, month_id(TS, zone))
    if not prefill:
        return joined
    return ffill_bfill(joined, (SERIES,), (BATCH,), chunk_hours=None)


def read_market(
    spark: SparkSession,
    price_path: str,
    load_path: str,
    generation_path: str,
    series: str | None = None,
    series_pattern: str | None = None,
    **options,
) -> DataFrame:
    """Market rows from files; the series comes from a name or from the path.

    A kind without a single readable document is an error.
    """

    def rows(path: str) -> DataFrame:
        ts = documents.required(documents.read_time_series(spark, path), str(path))
        named = (
            documents.with_series(ts, series_pattern)
            if series_pattern
            else ts.withColumn(SERIES, F.lit(series or "default"))
        )
        return documents.points(named)

    return market_table(
        documents.price_rows(rows(price_path)),
        documents.load_rows(rows(load_path)),
        documents.generation_rows(rows(generation_path)),
        **options,
    )


def weather_table(
    readings: DataFrame, locations: DataFrame, group_cols: Sequence[str] = (SERIES, TS)
) -> DataFrame:
    """Weighted weather per instant, with weights scaled to sum 1."""
    by = [SERIES] if SERIES in locations.columns else []
    weights = normalise_weights(locations, by)
    return weighted_mean(readings, weights, group_cols, [*by, "location"])


def clean_tables(market: DataFrame, weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Market with weather, cleaned per month, split into the two tables.

    The merged rows are staged: the axis reads their instants, the two tables
    their own columns, and neither parses or joins the documents again.
    """
    merged = staged(join_weather(market, weather), "merged")
    return split_columns(clean(merged, batch_cols=(BATCH,)), (SERIES, TS))


#: Version of rows that a backfill writes: older than any delivery.
BACKFILL_VERSION = "1970-01-01 00:00:00"


def backfill(
    market: DataFrame,
    weather: DataFrame,
    market_path: str,
    weather_path: str,
    version: str = BACKFILL_VERSION,
) -> None:
    """All months in one job per table; existing months are replaced.

    Rows carry ``ingest_ts`` like those of ``daily_update``, which replaces them.
    """
    stamp = F.lit(version).cast("timestamp")
    for rows, path in zip(clean_tables(market, weather), (market_path, weather_path)):
        tables.write_months(tables.as_double(rows).withColumn("ingest_ts", stamp), path)
