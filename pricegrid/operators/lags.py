"""Lags, rolling statistics and differences of one column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.chunks import (
    CHUNK,
    CHUNK_HOURS,
    home_rows,
    over,
    place,
    row_index,
    with_halo,
)
from pricegrid.schemas import DIFFS, LAGS, ROLLING

STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _frame_stats(value: str, parts: Sequence[str], ts_col: str, size: int) -> dict[str, str]:
    """Raw statistics over the ``size`` rows before the current one, and their count."""
    frame = over(parts, f"`{ts_col}`", f"{size} PRECEDING AND 1 PRECEDING")
    return {s: f"{fn}({value}) {frame}" for s, fn in {**STATS, "n": "count"}.items()}


def _shifted(name: str, steps: int) -> str:
    return f"`{name}`" if steps == 0 else f"`__{name}_{steps}`"


def _joined_stats(names: dict[str, str], size: int, base: int) -> dict[str, str]:
    """Statistics of a long frame from adjacent short frames of ``base`` rows.

    The long frame is the union of short frames that end 0, base, 2*base, ...
    rows earlier. Means are averaged, extremes nested, and squared deviations
    merged as within-frame plus between-frame parts, which stays stable for
    large values. A missing part makes the result missing.
    """
    steps = range(0, size, base)
    part = {stat: [_shifted(name, k) for k in steps] for stat, name in names.items()}
    mean = f"(({' + '.join(part['mean'])}) / {len(steps)})"
    squares = " + ".join(
        f"{s} * {s} * {base - 1} + ({m} - {mean}) * ({m} - {mean}) * {base}"
        for s, m in zip(part["std"], part["mean"])
    )
    full = f"CASE WHEN {mean} IS NOT NULL THEN"
    return {
        "mean": mean,
        "std": f"sqrt(({squares}) / {size - 1})",
        "min": f"{full} least({', '.join(part['min'])}) END",
        "max": f"{full} greatest({', '.join(part['max'])}) END",
    }


def lag_features(
    df: DataFrame,
    target_col: str = "price",
    lags: Sequence[int] = tuple(LAGS),
    windows: Sequence[int] = tuple(ROLLING),
    diffs: Sequence[int] = tuple(DIFFS),
    series_cols: Sequence[str] = ("series_id",),
    ts_col: str = "ts",
    suffix: str = "h",
    regular: bool = True,
    chunk_hours: int = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """Earlier values, statistics of the rows before, and changes of a column.

    Counted in rows per series. ``regular=True`` states that the axis is gap
    free and hourly (see ``hourly_grid``); ``regular=False`` numbers the rows
    first and is right for any spacing. ``parts`` is the number of partitions for
    the windows (see ``axis_partitions``).
    """
    if target_col not in df.columns:
        return df
    keys = list(series_cols)
    reach = max([*lags, *windows, *diffs])
    chunk_hours = max(chunk_hours, reach)
    kept = [c for c in df.columns if c != CHUNK]
    index_col = None
    if not regular:
        index_col = "__index"
        df = row_index(df, keys, ts_col, index_col=index_col)
    wide = with_halo(df, reach, keys, ts_col, chunk_hours, index_col)
    groups = [*keys, CHUNK]
    if parts is not None:
        wide = place(wide, groups, parts)
    value = f"`{target_col}`"
    window = over(groups, f"`{ts_col}`")

    def rolling(stat: str, size: int) -> str:
        return f"{target_col}_rolling_{stat}_{size}{suffix}"

    first = {f"{target_col}_lag_{k}{suffix}": f"lag({value}, {k}) {window}" for k in lags}
    first |= {
        f"{target_col}_diff_{k}{suffix}": f"{value} - lag({value}, {k}) {window}" for k in diffs
    }
    short: list[int] = []
    joined: dict[int, int] = {}
    for size in sorted(windows):
        base = next((b for b in reversed(short) if b > 1 and size % b == 0), None)
        if base is not None:
            joined[size] = base
            continue
        short.append(size)
        stats = _frame_stats(value, groups, ts_col, size)
        first |= {f"__{stat}_{size}": text for stat, text in stats.items()}
    out = wide.selectExpr("*", *[f"{text} AS `{name}`" for name, text in first.items()])
    # a frame that is not full has no statistics
    guarded = [
        f"CASE WHEN `__n_{size}` = {size} THEN `__{stat}_{size}` END AS `{rolling(stat, size)}`"
        for size in short
        for stat in STATS
    ]
    if guarded:
        out = out.selectExpr("*", *guarded)

    if joined:
        shifts = {
            (rolling(stat, base), k)
            for size, base in joined.items()
            for k in range(base, size, base)
            for stat in STATS
        }
        moved = [f"lag(`{n}`, {k}) {window} AS {_shifted(n, k)}" for n, k in sorted(shifts)]
        second = [
            f"{text} AS `{rolling(stat, size)}`"
            for size, base in joined.items()
            for stat, text in _joined_stats(
                {stat: rolling(stat, base) for stat in STATS}, size, base
            ).items()
        ]
        out = out.selectExpr("*", *moved).selectExpr("*", *second)
    order = [*kept, *[f"{target_col}_lag_{k}{suffix}" for k in lags]]
    order += [rolling(stat, size) for size in windows for stat in STATS]
    order += [f"{target_col}_diff_{k}{suffix}" for k in diffs]
    return home_rows(out).select(*order)


def lag_by_time(
    df: DataFrame,
    target_col: str,
    hours: int,
    series_cols: Sequence[str] = ("series_id",),
    ts_col: str = "ts",
    name: str | None = None,
) -> DataFrame:
    """Value exactly ``hours`` earlier, by equality of instants.

    Needs no order and no gap-free axis: a missing hour gives null, never the
    value of another hour.
    """
    name = name or f"{target_col}_lag_{hours}h"
    earlier = df.select(
        *series_cols,
        (F.col(ts_col) + F.make_dt_interval(hours=F.lit(hours))).alias(ts_col),
        F.col(target_col).alias(name),
    )
    return df.join(earlier, [*series_cols, ts_col], "left")
