"""Missing-value statistics, validity ranges and outlier clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.chunks import CHUNK, CHUNK_HOURS, add_chunk, drop_chunk
from pricegrid.schemas import OUTLIER_STD, PRICE_BOUNDS


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def _nan_free(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return nan_to_null(df, [c for c in cols if kinds.get(c) in ("double", "float")])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast columns to double; text that is no number becomes null, as does NaN."""
    names = [c for c in cols if c in df.columns]
    cast = df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in names})
    return nan_to_null(cast, names)


def missing_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column_name, missing_count, missing_pct`` of columns with any null."""
    names = list(cols) if cols is not None else df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(names)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("missing_count"))
        for i, c in enumerate(names)
    ]
    return (
        counts.select("__rows", F.inline(F.array(*pairs)))
        .where("missing_count > 0")
        .select(
            "column_name",
            "missing_count",
            F.round(F.col("missing_count") * 100.0 / F.col("__rows"), 2).alias("missing_pct"),
        )
    )


def quality_counts(
    df: DataFrame,
    series_cols: Sequence[str] = ("series_id",),
    key_cols: Sequence[str] = ("series_id", "ts"),
    value_cols: Sequence[str] | None = None,
    price_col: str = "price",
    bounds: tuple[float, float] = PRICE_BOUNDS,
) -> DataFrame:
    """Rows, duplicate keys, rows with any null and invalid prices per series.

    Keys are counted in a first aggregate over (series, key), so a distinct
    count never gathers one series in one task.
    """
    values = list(value_cols) if value_cols is not None else [
        c for c in df.columns if c not in (*series_cols, *key_cols)
    ]
    any_null = F.lit(False)
    for c in values:
        any_null = any_null | F.col(c).isNull()
    invalid = ~F.col(price_col).between(*bounds)
    per_key = df.groupBy(*dict.fromkeys([*series_cols, *key_cols])).agg(
        F.count(F.lit(1)).alias("__n"),
        F.count_if(any_null).alias("__null"),
        F.count_if(invalid).alias("__bad"),
    )
    return per_key.groupBy(*series_cols).agg(
        F.sum("__n").alias("row_count"),
        F.sum(F.col("__n") - 1).alias("duplicate_count"),
        F.sum("__null").alias("incomplete_rows"),
        F.sum("__bad").alias("invalid_prices"),
    )


def valid_range(
    df: DataFrame, price_col: str = "price", bounds: tuple[float, float] = PRICE_BOUNDS
) -> DataFrame:
    """Set prices outside the closed range to null; the gap repair fills them."""
    if price_col not in df.columns:
        return df
    price = F.col(price_col)
    return df.withColumn(price_col, F.when(price.between(*bounds), price))


def _clipped(c: str, n_std: float) -> str:
    low = f"(`__avg_{c}` - {n_std}D * `__std_{c}`)"
    high = f"(`__avg_{c}` + {n_std}D * `__std_{c}`)"
    return f"CASE WHEN `{c}` < {low} THEN {low} WHEN `{c}` > {high} THEN {high} ELSE `{c}` END"


def outlier_counts(
    df: DataFrame,
    cols: Sequence[str],
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    n_std: float = OUTLIER_STD,
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
) -> DataFrame:
    """Number of values beyond the bounds per (series, batch) and column; NaN is missing."""
    keys = [*series_cols, *batch_cols]
    df = _nan_free(df, cols)
    marked = _with_stats(df, cols, keys, ts_col, chunk_hours)
    return marked.groupBy(*keys).agg(
        *[
            F.count_if(
                F.abs(F.col(c) - F.col(f"__avg_{c}")) > n_std * F.col(f"__std_{c}")
            ).alias(f"{c}_outliers")
            for c in cols
        ]
    )


def _stats_of(cols: Sequence[str], window: str = "") -> list[str]:
    return [
        f"{fn}(`{c}`) {window} AS `__{short}_{c}`"
        for c in cols
        for short, fn in (("avg", "avg"), ("std", "stddev_samp"))
    ]


def _with_stats(df, cols, keys, ts_col, chunk_hours, stats_from=None):
    """Add mean and sample deviation per group to every row.

    ``stats_from`` may name a frame of the same rows that derives only ``cols``.
    """
    if not keys:
        # all moments in one aggregate, brought to the rows as one struct
        moments = df.agg(F.struct(*[F.expr(e) for e in _stats_of(cols)]).alias("__all")).scalar()
        parts = {f"__{s}_{c}": F.col("__all")[f"__{s}_{c}"] for c in cols for s in ("avg", "std")}
        return (
            add_chunk(df, ts_col, chunk_hours)
            .withColumn("__all", moments)
            .withColumns(parts)
            .drop("__all")
        )
    if chunk_hours is None:
        group = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)})"
        return df.selectExpr("*", *_stats_of(cols, group))
    # Moments are taken per chunk and merged over the chunks of a group. The
    # result returns to the rows by (group, chunk), so no group meets in a task.
    chunked = add_chunk(df, ts_col, chunk_hours)
    moments = []
    for c in cols:
        moments += [
            f"count(`{c}`) AS `__n_{c}`",
            f"avg(`{c}`) AS `__m_{c}`",
            f"var_pop(`{c}`) * count(`{c}`) AS `__q_{c}`",
        ]
    source = chunked if stats_from is None else add_chunk(stats_from, ts_col, chunk_hours)
    per_chunk = source.groupBy(*keys, CHUNK).agg(*[F.expr(e) for e in moments])
    group = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)})"
    merged = per_chunk.selectExpr(
        "*",
        *[f"sum(`__n_{c}`) {group} AS `__all_{c}`" for c in cols],
        *[
            f"try_divide(sum(`__n_{c}` * `__m_{c}`) {group}, sum(`__n_{c}`) {group}) AS `__avg_{c}`"
            for c in cols
        ],
    ).selectExpr(
        *[f"`{k}`" for k in keys],
        CHUNK,
        *[f"`__avg_{c}`" for c in cols],
        *[
            f"sqrt(try_divide(sum(`__q_{c}` + `__n_{c}` * (`__m_{c}` - `__avg_{c}`)"
            f" * (`__m_{c}` - `__avg_{c}`)) {group}, nullif(`__all_{c}` - 1, 0))) AS `__std_{c}`"
            for c in cols
        ],
    )
    # Every chunk has its row. A left join adds no null filters to the data side,
    # so its exchange stays the same as in the other branches and is reused.
    return chunked.join(merged, [*keys, CHUNK], "left")


def clip_columns(
    df, keys, cols, n_std, ts_col="ts", chunk_hours=CHUNK_HOURS, stats_from=None
):
    """``outlier_clip`` on named columns, keeping the chunk column."""
    names = add_chunk(df, ts_col, chunk_hours).columns
    marked = _with_stats(df, cols, keys, ts_col, chunk_hours, stats_from)
    clipped = {c: f"{_clipped(c, n_std)} AS `{c}`" for c in cols}
    return marked.selectExpr(*[clipped.get(c, f"`{c}`") for c in names])


def outlier_clip(
    df: DataFrame,
    cols: Sequence[str],
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    n_std: float = OUTLIER_STD,
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
) -> DataFrame:
    """Clip values to mean +/- ``n_std`` sample deviations per (series, batch).

    NaN counts as missing: it becomes null and takes no part in the statistics.
    """
    keys = [*series_cols, *batch_cols]
    names = [c for c in cols if c in df.columns]
    clean = _nan_free(df, names)
    return drop_chunk(clip_columns(clean, keys, names, n_std, ts_col, chunk_hours)).select(
        *df.columns
    )
