"""Splitting long series into bounded chunks of the time axis.

One series may hold a large share of all rows, so no window in this library is
partitioned by the series alone. Rows are grouped by (series, batch, chunk),
where a chunk is a fixed span of the axis. What has to cross a chunk edge is
either a bounded halo of rows (lags, rolling frames) or one summary row per
chunk (fills, positions), so only the summary is ever windowed over a series.

A batch column such as the calendar month bounds the group by itself; callers
then pass ``chunk_hours=None`` and no chunk column is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK = "__chunk"
CHUNK_HOURS = 4096
HOUR_US = 3_600_000_000
#: Rows of an axis for one task of a shuffle whose number of partitions is counted.
TASK_ROWS = 100_000


def micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def over(parts: Sequence[str], order: str, frame: str = "") -> str:
    """SQL text of a window. Expressions per column are written as SQL text
    throughout, which costs the driver one call per column instead of dozens."""
    by = f"PARTITION BY {', '.join(f'`{p}`' for p in parts)} " if parts else ""
    rows = f" ROWS BETWEEN {frame}" if frame else ""
    return f"OVER ({by}ORDER BY {order}{rows})"


def chunk_index(ts: str | Column, chunk_hours: int) -> Column:
    span = F.lit(chunk_hours * HOUR_US)
    us = micros(ts)
    return ((us - F.pmod(us, span)) / span).cast("long")


def add_chunk(df: DataFrame, ts_col: str, chunk_hours: int | None) -> DataFrame:
    """Add the chunk column unless it is there already or not wanted."""
    if chunk_hours is None or CHUNK in df.columns:
        return df
    return df.withColumn(CHUNK, chunk_index(ts_col, chunk_hours))


def group_keys(keys: Sequence[str], chunk_hours: int | None) -> list[str]:
    return [*keys, CHUNK] if chunk_hours is not None else list(keys)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions of about ``TASK_ROWS`` rows each, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def place(df: DataFrame, groups: Sequence[str], parts: int | None) -> DataFrame:
    """Bring the rows of a group together, in ``parts`` partitions or as many as the session has.

    The adaptive plan merges the session's partitions by the bytes that are shuffled. A
    span of the axis is a few bytes there and hundreds of wide rows behind it, so where
    series are many the caller counts the rows and states the number, which is kept.
    """
    if not groups:
        return df
    return df.repartition(*groups) if parts is None else df.repartition(parts, *groups)


def drop_chunk(df: DataFrame) -> DataFrame:
    return df.drop(CHUNK)


def row_index(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    ts_col: str = "ts",
    chunk_hours: int = CHUNK_HOURS,
    index_col: str = "row_index",
    total_col: str | None = None,
) -> DataFrame:
    """0-based position of every row within its series, in time order.

    Rows are counted per chunk first; the running total of those counts is the
    offset of the chunk, and row numbers are taken inside the chunk only.
    Instants must be unique per series.
    """
    chunked = add_chunk(df, ts_col, chunk_hours)
    counts = chunked.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    offsets = counts.select(
        *keys,
        CHUNK,
        F.coalesce(
            F.sum("__n").over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__offset"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__total"),
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(ts_col)
    numbered = chunked.withColumn("__rn", F.row_number().over(inside) - 1).join(
        offsets, [*keys, CHUNK], "left"
    )
    out = [F.col(c) for c in df.columns if c != CHUNK]
    out.append((F.col("__offset") + F.col("__rn")).alias(index_col))
    if total_col:
        out.append(F.col("__total").alias(total_col))
    return numbered.select(*out)


def with_halo(
    df: DataFrame,
    rows: int,
    keys: Sequence[str],
    ts_col: str = "ts",
    chunk_hours: int = CHUNK_HOURS,
    index_col: str | None = None,
) -> DataFrame:
    """Copy the last ``rows`` rows of every chunk into the next chunk.

    Adds the chunk column and ``__home`` (false for a copy). On a gap-free
    hourly axis the chunk is a span of time. With ``index_col`` (from
    ``row_index``) it is a span of positions, which is right for any spacing.
    """
    if rows > chunk_hours:
        raise ValueError(f"a lookback of {rows} rows needs chunks of at least that size")
    if index_col is None:
        span = F.lit(chunk_hours * HOUR_US)
        home = chunk_index(ts_col, chunk_hours)
        rest = F.pmod(micros(ts_col), span)
        in_tail = rest >= (chunk_hours - rows) * HOUR_US
    else:
        home = F.floor(F.col(index_col) / chunk_hours).cast("long")
        in_tail = F.pmod(F.col(index_col), F.lit(chunk_hours)) >= chunk_hours - rows
    target = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        df.drop(CHUNK)
        .select("*", home.alias("__of"), F.explode(target).alias(CHUNK))
        .withColumn("__home", F.col(CHUNK) == F.col("__of"))
        .drop("__of")
    )


def home_rows(df: DataFrame) -> DataFrame:
    """Remove halo copies and the helper columns."""
    return df.where("__home").drop("__home", CHUNK)
