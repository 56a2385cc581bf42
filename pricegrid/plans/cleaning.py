"""The cleaning job: axis, validity, gap repair, outlier clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pricegrid.operators.chunks import CHUNK_HOURS, drop_chunk, group_keys
from pricegrid.operators.fill import repair_columns
from pricegrid.operators.grid import axis_partitions, chunked_grid
from pricegrid.operators.quality import clip_columns, nan_to_null, valid_range
from pricegrid.schemas import BATCH, MAX_GAP_HOURS, MONTH, OUTLIER_STD, PRICE_BOUNDS, SERIES, TS


def clean(
    df: DataFrame,
    series_cols: Sequence[str] = (SERIES,),
    batch_cols: Sequence[str] = (MONTH,),
    ts_col: str = TS,
    price_col: str = "price",
    max_gap_hours: int = MAX_GAP_HOURS,
    n_std: float = OUTLIER_STD,
    bounds: tuple[float, float] = PRICE_BOUNDS,
    bounded_batches: bool | None = None,
    chunk_hours: int = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """Clean every (series, batch) on its own; one exchange of the data.

    NaN counts as missing from the start: it is repaired like a null, and takes no
    part in means and deviations.

    With the month as batch (the default) a group has at most 745 hours, so all
    steps run as windows on one placement. Without batch columns the series is
    repaired across month edges, in chunks.

    The windows of a row take some kilobytes, so the number of partitions follows the
    hours of all axes, which one aggregate counts unless ``parts`` is given.
    """
    keys = [*series_cols, *batch_cols]
    if bounded_batches is None:
        bounded_batches = MONTH in batch_cols or BATCH in batch_cols
    chunks = None if bounded_batches else chunk_hours
    numeric = [
        c
        for c, t in df.dtypes
        if c not in (*keys, ts_col) and t in ("double", "float", "int", "bigint")
    ]
    floating = [c for c in numeric if dict(df.dtypes)[c] in ("double", "float")]
    df = nan_to_null(df, floating)
    if parts is None:
        parts = axis_partitions(df, keys, ts_col)
    grid = chunked_grid(df, keys, ts_col, chunks, parts=parts)
    checked = valid_range(grid, price_col, bounds)
    repaired = repair_columns(checked, keys, numeric, max_gap_hours, ts_col, chunks, parts)
    clip = [c for c in numeric if c != price_col]
    # The second pass over a long series repairs the clipped columns alone: were
    # the price pruned from parts of it only, they could not share an exchange.
    few = checked.select(*group_keys(keys, chunks), ts_col, *clip)
    stats_from = repair_columns(few, keys, clip, max_gap_hours, ts_col, chunks, parts)
    clipped = clip_columns(repaired, keys, clip, n_std, ts_col, chunks, stats_from)
    return drop_chunk(clipped).select(*df.columns)
