"""Regular hourly axis per series (and batch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.chunks import (
    CHUNK,
    CHUNK_HOURS,
    HOUR_US,
    add_chunk,
    drop_chunk,
    group_keys,
    micros,
    partitions_for,
    place,
)


def _axis_spans(df, keys, ts_col, chunk_hours, until):
    """One row per group with the first and last grid instant inside it."""
    step = F.lit(HOUR_US)
    span = df.groupBy(*keys).agg(
        micros(F.min(ts_col)).alias("__lo"), micros(F.max(ts_col)).alias("__hi")
    )
    if until is not None:
        span = span.withColumn("__hi", F.greatest("__hi", micros(F.lit(until).cast("timestamp"))))
    if chunk_hours is None:
        return span.select(*keys, F.col("__lo").alias("__first"), F.col("__hi").alias("__last"))
    width = chunk_hours * HOUR_US
    lo_chunk = F.expr(f"(__lo - pmod(__lo, {width})) div {width}")
    hi_chunk = F.expr(f"(__hi - pmod(__hi, {width})) div {width}")
    start = F.col(CHUNK) * width
    skipped = F.expr(f"({CHUNK} * {width} - __lo + {HOUR_US - 1}) div {HOUR_US}")
    return (
        span.where(F.col("__lo").isNotNull())
        .select(*keys, "__lo", "__hi", F.explode(F.sequence(lo_chunk, hi_chunk)).alias(CHUNK))
        .select(
            *keys,
            CHUNK,
            F.when(start <= F.col("__lo"), F.col("__lo"))
            .otherwise(F.col("__lo") + skipped * step)
            .alias("__first"),
            F.least(F.col("__hi"), start + (width - 1)).alias("__last"),
        )
    )


def axis_partitions(
    df: DataFrame, keys: Sequence[str] = ("series_id",), ts_col: str = "ts", until=None
) -> int:
    """Number of partitions for the axis of ``df``, by the hours it will have.

    One aggregate over the keys; a single number comes to the driver.
    """
    span = df.groupBy(*keys).agg(
        micros(F.min(ts_col)).alias("__lo"), micros(F.max(ts_col)).alias("__hi"), F.count(F.lit(1)).alias("__n")
    )
    if until is not None:
        span = span.withColumn("__hi", F.greatest("__hi", micros(F.lit(until).cast("timestamp"))))
    rows = F.greatest(F.expr(f"(__hi - __lo) div {HOUR_US} + 1"), "__n")
    return partitions_for(df.sparkSession, span.agg(F.sum(rows)).first()[0] or 0)


def chunked_grid(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    until=None,
    parts: int | None = None,
) -> DataFrame:
    """``hourly_grid`` that keeps the chunk column for later operators.

    Axis spans (one row per group) travel through the same exchange as the data
    and are expanded to hours behind it, so the data is shuffled once and is
    already placed for the windows that follow.
    """
    data = add_chunk(df, ts_col, chunk_hours)
    spans = _axis_spans(df, keys, ts_col, chunk_hours, until).where("__first <= __last")
    values = [c for c in data.columns if c not in (*keys, ts_col, CHUNK)]
    groups = group_keys(keys, chunk_hours)
    both = data.withColumn("__us", micros(ts_col)).drop(ts_col).unionByName(
        spans, allowMissingColumns=True
    )
    placed = place(both, groups, parts)
    is_axis = F.col("__first").isNotNull()
    hours = F.when(
        is_axis,
        F.sequence(
            F.coalesce("__first", F.lit(0)),
            F.coalesce("__last", F.lit(0)),
            F.lit(HOUR_US),
        ),
    ).otherwise(F.array("__us"))
    return (
        placed.select(*groups, *values, is_axis.alias("__axis"), F.explode(hours).alias("__at"))
        .groupBy(*groups, "__at")
        .agg(F.max("__axis").alias("__axis"), *[F.max(c).alias(c) for c in values])
        .where("__axis")
        .select(*groups, F.timestamp_micros("__at").alias(ts_col), *values)
    )


def hourly_grid(
    df: DataFrame,
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    until=None,
    resample: str | None = None,
    keep_chunk: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """All hours from the first to the last instant of each (series, batch).

    The axis starts at the first instant, not at the full hour. Missing hours
    become rows of nulls and instants off the axis are dropped; instants must
    be unique. ``resample='mean'`` averages finer data into hours beforehand
    instead of dropping it. ``until`` extends the axis into the future. With
    ``keep_chunk`` a repair that follows, in chunks of the same size, finds the
    rows in place and does not shuffle them again, if it is given the same
    ``parts``: the number of partitions, see ``axis_partitions``.
    """
    if resample == "mean":
        values = [c for c in df.columns if c not in (*series_cols, *batch_cols, ts_col)]
        df = (
            df.withColumn(ts_col, F.date_trunc("hour", ts_col))
            .groupBy(*series_cols, *batch_cols, ts_col)
            .agg(*[F.avg(c).alias(c) for c in values])
        )
    elif resample is not None:
        raise ValueError(f"unknown resample method {resample!r}")
    keys = [*series_cols, *batch_cols]
    grid = chunked_grid(df, keys, ts_col, chunk_hours, until, parts)
    return grid if keep_chunk else drop_chunk(grid).select(*df.columns)
