"""Splitting rows into train, validation and test; month slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.chunks import CHUNK_HOURS, row_index
from pricegrid.schemas import VALIDATION_SHARE


def split_rows(
    df: DataFrame,
    test_start: Column,
    validation_share: float = VALIDATION_SHARE,
    series_cols: Sequence[str] = ("series_id",),
    ts_col: str = "ts",
    chunk_hours: int = CHUNK_HOURS,
) -> DataFrame:
    """Label rows ``train``, ``val`` or ``test`` in time order per series.

    Rows from ``test_start`` on are test. Of the rest, the first
    ``int(n * (1 - share))`` rows train and the remainder validates.
    """
    is_test = F.col(ts_col) >= test_start
    marked = df.withColumn("__test", is_test)
    indexed = row_index(
        marked, [*series_cols, "__test"], ts_col, chunk_hours, "__i", total_col="__n"
    )
    cut = F.floor(F.col("__n") * F.lit(1 - validation_share))
    label = (
        F.when(F.col("__test"), "test").when(F.col("__i") < cut, "train").otherwise("val")
    )
    return indexed.select(*df.columns, label.alias("split"))


def hash_split(
    df: DataFrame, keys: Sequence[str], test_share: float = 0.2, label_col: str = "split"
) -> DataFrame:
    """Repeatable random split by the MD5 of a key's text; independent of row order and engine."""
    text = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in keys])
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn(
        label_col, F.when(bucket < round(test_share * 10_000), "test").otherwise("train")
    )


def month_slices(
    df: DataFrame, start_col: str = "start_date", end_col: str = "end_date"
) -> DataFrame:
    """One row per month slice ``[slice_start, slice_end)`` of a date range.

    Slices start one month after each other. From a start on day 29 to 31 on,
    the day stays at the shortest month met so far, as when one month is added
    repeatedly. The slice list is built inside the row and then exploded.
    """
    plain = df.withColumn("__months", F.expr(
        f"sequence(0, greatest(0, CAST(months_between(trunc({end_col}, 'MM'), "
        f"trunc({start_col}, 'MM')) AS INT)))"
    ))
    first = f"trunc({start_col}, 'MM')"
    begin = (
        f"transform(__months, k -> date_add(add_months({first}, k), "
        f"least(day({start_col}), array_min(transform(sequence(0, k), "
        f"j -> CASE WHEN j = 0 THEN 31 ELSE day(last_day(add_months({first}, j))) END))) - 1))"
    )
    return (
        plain.withColumn("__starts", F.expr(begin))
        .select(*df.columns, F.posexplode("__starts").alias("slice_no", "slice_start"), "__starts")
        .where(F.col("slice_start") < F.col(end_col))
        .withColumn(
            "slice_end",
            F.least(
                F.coalesce(F.try_element_at("__starts", F.col("slice_no") + 2), F.col(end_col)),
                F.col(end_col),
            ),
        )
        .drop("__starts")
    )
