"""Features after a change: only what a changed value can reach is computed again.

A changed hour moves the lags and frames of the next 168 hours. Changes are reduced to
(series, UTC day); the days a change reaches, and those their lookback needs, are read,
put on the axis and engineered, everything else stays as it is stored. Runs of needed
days are series of their own, so an old and a new change don't span the years between.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricegrid.functions.timezones import month_id
from pricegrid.operators.chunks import HOUR_US, chunk_index, partitions_for
from pricegrid.plans.features import engineer_on_grid, lookback_hours
from pricegrid.schemas import SERIES, TS
from pricegrid.session import remove, staged_while
from pricegrid.sources import tables

DAY_HOURS = 24
DAY, RUN, REACHED = "__day", "__run", "__reached"


def changed_instants(
    delivery: DataFrame, stored: DataFrame | None, keys: Sequence[str] = (SERIES, TS), values: Sequence[str] | None = None
) -> DataFrame:
    """Keys of delivered rows that are not stored yet or differ in a value, once each.

    ``values`` are by default all columns that both sides have; null equals null. A key
    that is delivered more than once is changed if any of its rows is.
    """
    keys = list(keys)
    if stored is None:
        return delivery.select(*keys).distinct()
    if values is None:
        values = [c for c in delivery.columns if c in stored.columns and c not in keys]
    old = stored.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.struct(F.lit(1), *values).alias("__old"))
    same_key = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)]
    new = delivery.select(*keys, F.struct(F.lit(1), *values).alias("__new"))
    differs = [~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")) for c in values]
    changed = F.col("__old").isNull()
    for d in differs:
        changed = changed | d
    return new.join(old, same_key, "left").where(changed).select(*keys).distinct()


def reached_days(
    changed: DataFrame, series_cols: Sequence[str] = (SERIES,), ts_col: str = TS, hours: int | None = None
) -> DataFrame:
    """Days to read, per series, with the run they belong to and whether a change reaches them.

    One row per (series, day): the windows below are as long as the axis has days,
    however many rows a series has. Changes without an instant reach nothing.
    """
    days = -(-(lookback_hours() if hours is None else hours) // DAY_HOURS)
    hit = changed.where(F.col(ts_col).isNotNull()).select(*series_cols, chunk_index(ts_col, DAY_HOURS).alias("__hit"))
    around = F.explode(F.sequence(F.col("__hit") - days, F.col("__hit") + days))
    each = hit.distinct().select(*series_cols, "__hit", around.alias(DAY))
    needed = each.groupBy(*series_cols, DAY).agg(F.max(F.col(DAY) >= F.col("__hit")).alias(REACHED))
    order = Window.partitionBy(*series_cols).orderBy(DAY)
    return needed.withColumn(RUN, F.col(DAY) - F.row_number().over(order))


def _day_start(day: Column) -> Column:
    return F.timestamp_micros(day * F.lit(DAY_HOURS * HOUR_US))


def reached_features(
    history: DataFrame, days: DataFrame, series_cols: Sequence[str] = (SERIES,), ts_col: str = TS, **options
) -> DataFrame:
    """The rows of ``history`` on reached days with all features, as a full run gives them.

    ``days`` comes from :func:`reached_days`. Instants have to lie on the hourly axis of
    their series, as the ingest stores them.
    """
    keys = list(series_cols)
    wanted = days.select(*[F.col(c).alias(f"__s{i}") for i, c in enumerate(keys)], F.col(DAY).alias("__d"), RUN, REACHED)
    match = [F.col(c).eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(keys)]
    rows = history.join(wanted, [*match, chunk_index(ts_col, DAY_HOURS) == F.col("__d")])
    rows = rows.select(*history.columns, RUN, REACHED)
    parts = partitions_for(history.sparkSession, DAY_HOURS * days.count())
    done = engineer_on_grid(rows, series_cols=[*keys, RUN], ts_col=ts_col, parts=parts, **options)
    return done.where(REACHED).drop(RUN, REACHED)


def refresh(
    changed: DataFrame,
    read: Callable[[list[str]], DataFrame],
    features_path: str,
    version,
    series_cols: Sequence[str] = (SERIES,),
    ts_col: str = TS,
    version_col: str = "ingest_ts",
    **options,
) -> list[str]:
    """Compute the features that ``changed`` can reach again and upsert them.

    ``read`` returns the history of the months it is given. Returns these months: their
    names, one short string each, are all that reaches the driver. May be repeated.
    """
    with staged_while(reached_days(changed, series_cols, ts_col), "reached") as days:
        months = [r[0] for r in days.select(month_id(_day_start(F.col(DAY)))).distinct().collect()]
        if months:
            done = reached_features(read(sorted(months)), days, series_cols, ts_col, **options)
            stamped = tables.as_double(done, [*series_cols, ts_col]).withColumn(version_col, version)
            tables.upsert(stamped, features_path, [*series_cols, ts_col], version_col, ts_col)
        return sorted(months)


def note_changes(changed: DataFrame, features_path: str) -> None:
    """Write changed keys beside the features, before the rows themselves are stored."""
    changed.write.mode("append").parquet(_pending(features_path))


def pending_changes(spark: SparkSession, features_path: str) -> DataFrame | None:
    """Changes that no finished refresh has taken up, or None."""
    try:
        return spark.read.parquet(_pending(features_path))
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def forget_changes(spark: SparkSession, features_path: str) -> None:
    remove(spark, _pending(features_path))


def _pending(features_path: str) -> str:
    return f"{features_path.rstrip('/')}_pending"
