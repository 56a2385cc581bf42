"""Axis, repair, clipping and windows against a plain pandas model."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricegrid.operators.chunks import row_index
from pricegrid.operators.fill import ffill_bfill, gap_repair, null_runs
from pricegrid.operators.grid import hourly_grid
from pricegrid.operators.lags import lag_by_time, lag_features
from pricegrid.operators.quality import outlier_clip, valid_range
from pricegrid.plans.cleaning import clean
from pricegrid.plans.features import engineer, engineer_on_grid, engineer_range
from pricegrid.sources.tables import with_month

CHUNK = 200  # far below the length of the test series


def series(seed, n=900, start="2024-01-20 00:30:00"):
    """Hourly values with single gaps, long runs, a leading and a trailing run."""
    rng = np.random.default_rng(seed)
    ts = pd.date_range(start, periods=n, freq="h")
    out = pd.DataFrame({"series_id": f"s{seed}", "ts": ts})
    for c in ("price", "load_forecast"):
        v = rng.normal(50, 20, n)
        v[rng.random(n) < 0.2] = np.nan
        for length in (3, 6, 7, 30, 450):
            at = int(rng.integers(0, n - length))
            v[at : at + length] = np.nan
        v[: int(rng.integers(1, 9))] = np.nan
        v[-int(rng.integers(1, 9)) :] = np.nan
        out[c] = v
    return out


@pytest.fixture(scope="module")
def frame():
    return pd.concat([series(1), series(2), series(3)], ignore_index=True)


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf)
    values = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in values})


def collect(df, keys=("series_id", "ts")):
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


def repaired_model(v: pd.Series, max_gap: int) -> pd.Series:
    run = (v.isna() != v.isna().shift()).cumsum()
    length = v.isna().groupby(run).transform("sum")
    linear = v.interpolate("linear")
    out = v.where(v.notna(), np.where(length <= max_gap, linear, v.ffill()))
    return out.bfill().ffill()


def same(a, b):
    np.testing.assert_allclose(
        a.to_numpy(dtype=float), b.to_numpy(dtype=float), rtol=1e-9, atol=1e-9
    )


@pytest.mark.parametrize("max_gap", [3, 6])
@pytest.mark.parametrize("chunk", [CHUNK, 4096, None])
def test_gap_repair(spark, frame, max_gap, chunk):
    got = collect(gap_repair(to_spark(spark, frame), max_gap_hours=max_gap, chunk_hours=chunk))
    for c in ("price", "load_forecast"):
        want = frame.groupby("series_id")[c].transform(lambda v: repaired_model(v, max_gap))
        same(got[c], want)
        assert got[c].notna().all()


def test_all_null_column_stays_null(spark, frame):
    pdf = frame.assign(price=np.nan)
    got = collect(gap_repair(to_spark(spark, pdf), chunk_hours=CHUNK))
    assert got["price"].isna().all()


def test_single_row(spark):
    pdf = pd.DataFrame({"series_id": ["a"], "ts": [pd.Timestamp("2024-01-01")], "price": [5.0]})
    assert collect(gap_repair(to_spark(spark, pdf)))["price"].tolist() == [5.0]


def test_ffill_bfill(spark, frame):
    got = collect(ffill_bfill(to_spark(spark, frame), chunk_hours=CHUNK))
    want = frame.groupby("series_id")["price"].transform(lambda v: v.ffill().bfill())
    same(got["price"], want)


def test_null_runs(spark, frame):
    got = null_runs(to_spark(spark, frame), "price", chunk_hours=CHUNK).toPandas()
    null = frame["price"].isna()
    run = (null != null.shift()).cumsum() + frame["series_id"].map({"s1": 0, "s2": 10**6, "s3": 2 * 10**6})
    want = frame[null].groupby(run[null])["ts"].agg(["min", "max", "count"])
    assert sorted(zip(got.run_start, got.run_end, got.run_len)) == sorted(
        want.itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("chunk", [CHUNK, None])
def test_hourly_grid(spark, frame, chunk):
    rng = np.random.default_rng(7)
    holes = frame[rng.random(len(frame)) > 0.4]
    holes = holes[~((holes.ts > "2024-01-25") & (holes.ts < "2024-02-14"))]  # empty chunks
    off = holes.iloc[[5, 50]].assign(ts=lambda d: d.ts + pd.Timedelta(minutes=10))
    got = collect(hourly_grid(to_spark(spark, pd.concat([holes, off])), chunk_hours=chunk))
    parts = []
    for name, g in holes.groupby("series_id"):
        axis = pd.date_range(g.ts.min(), g.ts.max(), freq="h")
        parts.append(g.set_index("ts").reindex(axis).rename_axis("ts").reset_index().assign(series_id=name))
    want = pd.concat(parts, ignore_index=True)
    assert got.ts.tolist() == want.ts.tolist()
    same(got["price"], want["price"])


def test_grid_of_quarter_hours_keeps_one_in_four_or_averages(spark):
    ts = pd.date_range("2024-03-01", periods=16, freq="15min")
    pdf = pd.DataFrame({"series_id": "a", "ts": ts, "price": np.arange(16.0)})
    assert collect(hourly_grid(to_spark(spark, pdf)))["price"].tolist() == [0, 4, 8, 12]
    mean = collect(hourly_grid(to_spark(spark, pdf), resample="mean"))["price"].tolist()
    assert mean == [1.5, 5.5, 9.5, 13.5]


def test_grid_without_series_and_into_the_future(spark):
    ts = pd.to_datetime(["2024-03-01 00:00", "2024-03-01 02:00"])
    pdf = pd.DataFrame({"ts": ts, "price": [1.0, 2.0]})
    got = collect(hourly_grid(to_spark(spark, pdf), series_cols=(), until="2024-03-01 04:00"), ["ts"])
    assert got["price"].fillna(-1).tolist() == [1, -1, 2, -1, -1]


def test_row_index(spark, frame):
    holes = frame[np.random.default_rng(3).random(len(frame)) > 0.5]
    got = collect(row_index(to_spark(spark, holes), chunk_hours=CHUNK, total_col="n"))
    assert (got.row_index == got.groupby("series_id").cumcount()).all()
    assert (got.n == got.groupby("series_id")["ts"].transform("size")).all()


def lag_model(v: pd.Series) -> pd.DataFrame:
    out = {f"price_lag_{k}h": v.shift(k) for k in (1, 24, 168)}
    for n in (24, 168):
        r = v.shift(1).rolling(n)
        out |= {f"price_rolling_{s}_{n}h": getattr(r, s)() for s in ("mean", "std", "min", "max")}
    out |= {f"price_diff_{k}h": v.diff(k) for k in (1, 24)}
    return pd.DataFrame(out)


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("regular", [True, False])
def test_lag_features(spark, frame, nulls, regular):
    pdf = frame.drop(columns="load_forecast").copy()
    if not nulls:
        pdf["price"] = pdf.groupby("series_id")["price"].transform(lambda v: v.ffill().bfill())
    else:
        pdf.loc[pdf.index % 400 != 399, "price"] = pdf["price"].fillna(40.0)
    if not regular:
        pdf = pdf[np.random.default_rng(5).random(len(pdf)) > 0.3]
    got = collect(lag_features(to_spark(spark, pdf), regular=regular, chunk_hours=CHUNK))
    want = pd.concat([lag_model(g["price"]) for _, g in pdf.groupby("series_id")])
    for c in want.columns:
        assert (got[c].isna().to_numpy() == want[c].isna().to_numpy()).all(), c
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-7, atol=1e-7)


def test_lags_do_not_see_later_rows(spark, frame):
    pdf = frame.assign(price=frame["price"].fillna(40.0))
    cut = pdf.ts.max() - pd.Timedelta(hours=100)
    later = pdf.assign(price=pdf["price"].where(pdf.ts <= cut, 9999.0))
    a, b = (collect(lag_features(to_spark(spark, p), chunk_hours=CHUNK)) for p in (pdf, later))
    early = a.ts <= cut
    pd.testing.assert_frame_equal(a[early], b[early])


def test_rolling_bounds(spark, frame):
    pdf = frame.assign(price=frame["price"].fillna(40.0))
    got = collect(lag_features(to_spark(spark, pdf), chunk_hours=CHUNK)).dropna()
    for n in (24, 168):
        low, mid, high = (got[f"price_rolling_{s}_{n}h"] for s in ("min", "mean", "max"))
        assert ((low <= mid + 1e-9) & (mid <= high + 1e-9)).all()


def test_lag_by_time_gives_null_for_a_missing_hour(spark):
    ts = pd.to_datetime(["2024-03-01 00:00", "2024-03-01 02:00", "2024-03-01 03:00"])
    pdf = pd.DataFrame({"series_id": "a", "ts": ts, "price": [1.0, 2.0, 3.0]})
    got = collect(lag_by_time(to_spark(spark, pdf), "price", 1))["price_lag_1h"]
    assert got.fillna(-1).tolist() == [-1, -1, 2]


@pytest.mark.parametrize("chunk", [CHUNK, None])
def test_outlier_clip(spark, frame, chunk):
    pdf = frame.assign(load_forecast=frame["load_forecast"].fillna(50.0))
    pdf.loc[[10, 20], "load_forecast"] = [1e4, -1e4]
    got = collect(outlier_clip(to_spark(spark, pdf), ["load_forecast"], chunk_hours=chunk))

    def clip(v):
        return v.clip(v.mean() - 4 * v.std(), v.mean() + 4 * v.std())

    same(got["load_forecast"], pdf.groupby("series_id")["load_forecast"].transform(clip))


def test_constant_column_is_not_clipped(spark):
    ts = pd.date_range("2024-03-01", periods=5, freq="h")
    pdf = pd.DataFrame({"series_id": "a", "ts": ts, "price": 1.0, "load_forecast": 3.0})
    assert collect(outlier_clip(to_spark(spark, pdf), ["load_forecast"]))["load_forecast"].eq(3).all()


def test_valid_range_is_closed(spark):
    pdf = pd.DataFrame({"price": [-500.1, -500.0, 0.0, 1000.0, 1000.1]})
    got = valid_range(to_spark(spark, pdf)).toPandas()["price"]
    assert got.isna().tolist() == [True, False, False, False, True]


def test_clean_repairs_each_month_alone(spark, frame):
    df = with_month(to_spark(spark, frame))
    got = collect(clean(df))
    assert got.groupby(["series_id", "part_month"]).ts.diff().dropna().eq(pd.Timedelta("1h")).all()
    month = frame.ts.dt.strftime("%Y-%m")
    want = frame.groupby([frame.series_id, month])["price"].transform(lambda v: repaired_model(v, 6))
    same(got["price"], want)
    whole = collect(clean(to_spark(spark, frame), batch_cols=(), chunk_hours=CHUNK))
    want = frame.groupby("series_id")["price"].transform(lambda v: repaired_model(v, 6))
    same(whole["price"], want)


def full_input(frame):
    rng = np.random.default_rng(11)
    n = len(frame)
    return frame.assign(
        price=frame["price"].fillna(40.0),
        load_forecast=frame["load_forecast"].fillna(50.0),
        wind_forecast=rng.uniform(0, 30, n),
        solar_forecast=rng.uniform(0, 30, n),
        temperature_avg=rng.uniform(-5, 25, n),
        wind_speed_10m_avg=rng.uniform(0, 9, n),
        wind_speed_80m_avg=rng.uniform(0, 15, n),
        irradiance_avg=rng.uniform(0, 500, n),
    )


def test_engineer_has_42_columns_and_skips_absent_inputs(spark, frame):
    df = to_spark(spark, full_input(frame))
    assert len(engineer(df).columns) == 42 + 1  # the series key is ours
    few = engineer(df.select("series_id", "ts", "temperature_avg"))
    assert "residual_load" not in few.columns and "price_lag_1h" not in few.columns
    assert "hour" in few.columns
    assert "price_lag_1h" not in engineer(df, include_lag=False).columns


def test_engineer_range_equals_a_cut_of_everything(spark, frame):
    df = to_spark(spark, full_input(frame))
    a, b = "2024-02-05 00:30:00", "2024-02-08 00:30:00"
    part = collect(engineer_range(df, a, b, chunk_hours=CHUNK))
    whole = collect(engineer(df, chunk_hours=CHUNK))
    whole = whole[(whole.ts >= a) & (whole.ts <= b)].reset_index(drop=True)
    pd.testing.assert_frame_equal(part, whole, rtol=1e-9)


@pytest.mark.parametrize("chunk", [200, 256, 4096])
def test_lags_on_an_axis_with_a_hole_do_not_depend_on_the_chunk(spark, chunk):
    hours = [h for h in range(540) if not 200 <= h < 260]
    base = pd.Timestamp("2024-01-01")
    pdf = pd.DataFrame(
        {"series_id": 1, "ts": [base + pd.Timedelta(hours=h) for h in hours], "price": [float(h * h % 101) for h in hours]}
    )
    got = collect(engineer_on_grid(to_spark(spark, pdf), chunk_hours=chunk))
    value = dict(zip(hours, pdf.price))
    assert len(got) == len(hours)
    for h, lag in zip(hours, got.price_lag_24h):
        want = value.get(h - 24)
        assert (want is None and pd.isna(lag)) or want == lag


def test_nan_is_missing_everywhere(spark):
    rows = [(1, f"2024-01-01 0{h}:00:00", float("nan") if h == 2 else 10.0 + h) for h in range(5)]
    df = spark.createDataFrame(rows, "series_id long, ts string, load_forecast double")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    cleaned = clean(with_month(df), price_col="load_forecast").orderBy("ts").collect()
    assert [r.load_forecast for r in cleaned] == [10.0, 11.0, 12.0, 13.0, 14.0]
    clipped = outlier_clip(df, ["load_forecast"]).orderBy("ts").collect()
    assert [r.load_forecast for r in clipped] == [10.0, 11.0, None, 13.0, 14.0]
