"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], rank, agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = agg(F.struct(*rest), rank).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in arrival order, as a whole; nulls in ``order`` come last.

    An aggregate, so copies of one key are reduced before the shuffle. Of rows that
    tie in ``order`` any one stays.
    """
    rank = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    return _pick(df, keys, rank, F.min_by)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in arrival order, as a whole; nulls in ``order`` come first."""
    rank = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order])
    return _pick(df, keys, rank, F.max_by)
