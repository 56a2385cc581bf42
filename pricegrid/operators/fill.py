"""Forward and backward fill, gap repair and null runs on an hourly axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.chunks import (
    CHUNK,
    CHUNK_HOURS,
    HOUR_US,
    add_chunk,
    chunk_index,
    drop_chunk,
    group_keys,
    over,
    place,
)
from pricegrid.schemas import DEFAULT_GAP_HOURS

_SO_FAR = "UNBOUNDED PRECEDING AND CURRENT ROW"
_EARLIER = "UNBOUNDED PRECEDING AND 1 PRECEDING"


def _edge_rows(chunked, cols, keys, ts_col) -> DataFrame:
    """What each chunk has to know from the others, as rows of its own.

    Per column the last known row before the chunk and the first known row
    behind it, with their own instants and no other column set. They come from
    one summary row per chunk, which is all that a window over a series sees.
    """
    groups = [*keys, CHUNK]
    edges = []
    for c in cols:
        at = f"nvl2(`{c}`, `{ts_col}`, NULL)"
        edges += [
            f"min_by(`{c}`, {at}) AS `__fv_{c}`",
            f"max_by(`{c}`, {at}) AS `__lv_{c}`",
            f"min({at}) AS `__ft_{c}`",
            f"max({at}) AS `__lt_{c}`",
        ]
    carried = chunked.groupBy(*groups).agg(*[F.expr(e) for e in edges])
    for side, edge, order in (("p", "l", CHUNK), ("n", "f", f"{CHUNK} DESC")):
        window = over(keys, order, _EARLIER)
        carried = carried.selectExpr(
            "*",
            *[
                f"last(`__{edge}{k}_{c}`, true) {window} AS `__{side}{k}_{c}`"
                for c in cols
                for k in ("v", "t")
            ],
        )
    types = dict(chunked.dtypes)
    rows = [
        f"named_struct('{ts_col}', `__{side}t_{c}`, "
        + ", ".join(
            f"'{o}', " + (f"`__{side}v_{c}`" if o == c else f"CAST(NULL AS {types[o]})")
            for o in cols
        )
        + ")"
        for c in cols
        for side in ("p", "n")
    ]
    names = [f"`{g}`" for g in groups]
    return carried.selectExpr(*names, f"inline(array({', '.join(rows)}))").where(
        F.col(ts_col).isNotNull()
    )


def neighbours(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    need_times: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """Last known value at or before, first known value at or after each row.

    Adds ``__pv_<c>``, ``__nv_<c>`` and, if wanted, the hours since 1970 of
    those rows as ``__pt_<c>``, ``__nt_<c>`` and of the row itself as ``__hour``
    (whole numbers, as the rows of an axis share their minutes). Both directions run as frames from the start of a partition;
    the backward one sorts descending, since a frame that ends at the last row
    is evaluated anew for every row. What lies beyond a chunk is placed beside
    its rows beforehand, hashed the same way, so the data is not moved for it.
    """
    chunked = add_chunk(df, ts_col, chunk_hours)
    groups = group_keys(keys, chunk_hours)
    kinds = ["v", "t"] if need_times else ["v"]

    def known(c: str, kind: str) -> str:
        return f"`{c}`" if kind == "v" else f"nvl2(`{c}`, __hour, NULL)"

    near = chunked
    if chunk_hours is not None:
        edges = place(_edge_rows(chunked, cols, keys, ts_col), groups, parts)
        near = place(chunked, groups, parts).unionByName(edges, allowMissingColumns=True)
    if need_times:
        us = f"unix_micros(`{ts_col}`)"
        near = near.selectExpr("*", f"({us} - pmod({us}, {HOUR_US})) / {HOUR_US} AS __hour")
    for side, order in (("p", f"`{ts_col}`"), ("n", f"`{ts_col}` DESC")):
        window = over(groups, order, _SO_FAR)
        near = near.selectExpr(
            "*",
            *[
                f"last({known(c, k)}, true) {window} AS `__{side}{k}_{c}`"
                for c in cols
                for k in kinds
            ],
        )
    if chunk_hours is not None:
        # Null-safe, since plain equality would push a null filter into this branch
        # alone and keep its exchange from being shared with the edge rows.
        near = near.where(chunk_index(ts_col, chunk_hours).eqNullSafe(F.col(CHUNK)))
    return near


def _value_columns(df: DataFrame, cols, skip) -> list[str]:
    if cols is not None:
        return list(cols)
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    return [
        c
        for c, t in df.dtypes
        if c not in skip and (t in numeric or t.startswith("decimal"))
    ]


def ffill_bfill(
    df: DataFrame,
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    cols: Sequence[str] | None = None,
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """Forward fill, then backward fill of the leading rows."""
    keys = [*series_cols, *batch_cols]
    names = list(cols) if cols is not None else [
        c for c in df.columns if c not in (*keys, ts_col, CHUNK)
    ]
    near = neighbours(df, names, keys, ts_col, chunk_hours, need_times=False, parts=parts)
    filled = {c: f"coalesce(`__pv_{c}`, `__nv_{c}`) AS `{c}`" for c in names}
    return drop_chunk(near.selectExpr(*[filled.get(c, f"`{c}`") for c in df.columns]))


def _repaired(c: str, max_gap: int) -> str:
    pv, nv, pt, nt = (f"`__{k}_{c}`" for k in ("pv", "nv", "pt", "nt"))
    return (
        f"CASE WHEN `{c}` IS NOT NULL THEN `{c}` WHEN {pv} IS NULL THEN {nv} "
        f"WHEN {nv} IS NULL OR {nt} - {pt} > {max_gap + 1} THEN {pv} "
        f"ELSE {pv} + try_divide(({nv} - {pv}) * (__hour - {pt}), {nt} - {pt}) END AS `{c}`"
    )


def repair_columns(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    max_gap_hours: int,
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """``gap_repair`` on named columns, keeping the chunk column."""
    near = neighbours(df, cols, keys, ts_col, chunk_hours, parts=parts)
    names = add_chunk(df, ts_col, chunk_hours).columns
    fixed = {c: _repaired(c, max_gap_hours) for c in cols}
    return near.selectExpr(*[fixed.get(c, f"`{c}`") for c in names])


def gap_repair(
    df: DataFrame,
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    cols: Sequence[str] | None = None,
    max_gap_hours: int = DEFAULT_GAP_HOURS,
    method: str = "linear",
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """Fill nulls of numeric columns on a gap-free hourly axis.

    Runs of up to ``max_gap_hours`` are interpolated, longer runs repeat the
    last value, leading runs take the first and trailing runs the last value.
    ``linear`` (by row) and ``time`` agree on an hourly axis.
    """
    if method not in ("linear", "time"):
        raise ValueError(f"unknown interpolation method {method!r}")
    keys = [*series_cols, *batch_cols]
    names = _value_columns(df, cols, (*keys, ts_col, CHUNK))
    return drop_chunk(repair_columns(df, keys, names, max_gap_hours, ts_col, chunk_hours, parts))


def null_runs(
    df: DataFrame,
    col: str,
    series_cols: Sequence[str] = ("series_id",),
    batch_cols: Sequence[str] = (),
    ts_col: str = "ts",
    chunk_hours: int | None = CHUNK_HOURS,
    parts: int | None = None,
) -> DataFrame:
    """One row per run of consecutive nulls: ``run_start, run_end, run_len``.

    A run is named by the known rows around it, so runs longer than a chunk
    need no stitching and are pre-aggregated before the shuffle.
    """
    keys = [*series_cols, *batch_cols]
    near = neighbours(df.select(*keys, ts_col, col), [col], keys, ts_col, chunk_hours, parts=parts)
    return (
        near.where(F.col(col).isNull())
        .groupBy(*keys, F.col(f"__pt_{col}").alias("__after"))
        .agg(
            F.min(ts_col).alias("run_start"),
            F.max(ts_col).alias("run_end"),
            F.count(F.lit(1)).alias("run_len"),
        )
        .drop("__after")
    )
