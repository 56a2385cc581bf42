"""Scalar features, time zones, joins and small operators on edge cases."""

import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricegrid.functions.errors import error_metrics
from pricegrid.functions.features import interaction_features, market_features, time_features
from pricegrid.functions.timezones import local_to_utc, utc_to_local
from pricegrid.operators import reports as r
from pricegrid.operators.dedupe import keep_first, keep_latest
from pricegrid.operators.market import wide_generation, wide_load
from pricegrid.operators.quality import coerce_numeric, missing_stats, quality_counts
from pricegrid.operators.splits import hash_split, month_slices, split_rows
from pricegrid.operators.weather import normalise_weights, weighted_mean
from pricegrid.sources.documents import default_locations


def rows(df):
    return [tuple(x) for x in df.collect()]


def test_calendar(spark):
    stamps = ["2024-02-29 07:00", "2024-12-30 20:00", "2023-01-01 00:00", "2024-06-06 17:00", "2024-06-08 10:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp("s", "yyyy-MM-dd HH:mm").alias("ts"))
    got = {str(x.ts)[:10]: x for x in time_features(df).collect()}
    leap = got["2024-02-29"]
    assert (leap.day_of_year, leap.day_of_week, leap.is_peak_morning, leap.is_holiday) == (60, 3, 1, 0)
    assert got["2024-12-30"].week_of_year == 1 and got["2024-12-30"].is_peak_evening == 1
    assert got["2023-01-01"].week_of_year == 52 and got["2023-01-01"].is_holiday == 1
    assert got["2024-06-06"].is_holiday == 1 and got["2024-06-08"].is_weekend == 1
    assert math.isclose(leap.hour_sin, math.sin(2 * math.pi * 7 / 24))


def test_market_edges(spark):
    df = spark.createDataFrame(
        [(0.0, 5.0, 0.0), (0.0, 0.0, 0.0), (10.0, 20.0, 5.0), (10.0, None, 1.0), (10.0, 2.0, 3.0)],
        "load_forecast double, wind_forecast double, solar_forecast double",
    )
    got = rows(market_features(df).select("renewable_ratio", "renewable_surplus", "load_stress"))
    assert got == [(1.0, 5.0, None), (None, 0.0, None), (1.0, 15.0, -1.5), (None, 0.0, None), (0.5, 0.0, 0.5)]


def test_interaction_edges(spark):
    df = spark.createDataFrame(
        [(0.0, 8.0), (None, 8.0), (2.0, 8.0), (2.0, None)],
        "wind_speed_80m_avg double, wind_forecast double",
    )
    got = interaction_features(df)
    assert [x.wind_efficiency for x in got.collect()] == [0.0, 0.0, 1.0, None]
    assert "temp_load_interaction" not in got.columns


@pytest.mark.parametrize(
    "local, first, null",
    [
        ("2024-03-31 01:00", "2024-03-31 00:00:00", "2024-03-31 00:00:00"),
        ("2024-03-31 02:00", "2024-03-31 01:00:00", "2024-03-31 01:00:00"),
        ("2024-03-31 02:30", "2024-03-31 01:00:00", "2024-03-31 01:00:00"),
        ("2024-10-27 02:00", "2024-10-27 00:00:00", None),
        ("2024-10-27 03:00", "2024-10-27 02:00:00", "2024-10-27 02:00:00"),
        ("2024-07-01 12:00", "2024-07-01 10:00:00", "2024-07-01 10:00:00"),
    ],
)
def test_local_to_utc(spark, local, first, null):
    df = spark.createDataFrame([(local,)], "s string").select(F.to_timestamp_ntz("s", F.lit("yyyy-MM-dd HH:mm")).alias("t"))
    got = df.select(
        local_to_utc("t").cast("string"), local_to_utc("t", ambiguous="null").cast("string")
    )
    assert rows(got) == [(first, null)]


def test_utc_to_local(spark):
    df = spark.sql("select timestamp'2024-07-01 10:00:00' as ts")
    assert rows(df.select(utc_to_local("ts").cast("string"))) == [("2024-07-01 12:00:00",)]


def test_keep_first_and_latest(spark):
    df = spark.createDataFrame(
        [("a", "f1", 2, 20.0), ("a", "f1", 1, None), ("a", "f0", 9, 90.0), ("b", "f1", 1, 1.0)],
        "k string, file string, pos int, v double",
    )
    assert sorted(rows(keep_first(df, ["k"], ["file", "pos"]).select("k", "v"))) == [("a", 90.0), ("b", 1.0)]
    # a null in the kept row stays null
    assert rows(keep_first(df.where("file = 'f1' and k = 'a'"), ["k"], ["pos"]).select("v")) == [(None,)]
    assert sorted(rows(keep_latest(df, ["k"], ["file", "pos"]).select("k", "v"))) == [("a", 20.0), ("b", 1.0)]


def test_wide_tables(spark):
    df = spark.createDataFrame([("t", 1.0, None, 3.0, 4.0)], "ts string, `Wind Off` double, WINDON double, solar double, `Solar X` double")
    got = wide_generation(df, ["ts"])
    assert rows(got) == [("t", None, 3.0)]
    assert rows(wide_generation(df.select("ts", "Wind Off"), ["ts"])) == [("t", 1.0, 0.0)]
    assert rows(wide_load(df.select("ts", "Wind Off", "WINDON", "solar"), ["ts"])) == [("t", 2.0)]
    assert rows(wide_load(df.select("ts", "WINDON"), ["ts"])) == [("t", None)]


def test_coerce(spark):
    df = spark.createDataFrame([("1.5", "x"), ("NaN", ""), (None, "2")], "a string, b string")
    assert rows(coerce_numeric(df, ["a", "b", "absent"])) == [(1.5, None), (None, None), (None, 2.0)]


def test_missing_stats(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, None)], "a int, b double")
    assert rows(missing_stats(df)) == [("b", 2, 66.67)]


def test_quality_counts(spark):
    df = spark.createDataFrame(
        [("s", 1, 5.0), ("s", 1, 5.0), ("s", 2, None), ("s", 3, 2000.0)], "series_id string, ts int, price double"
    )
    assert rows(quality_counts(df)) == [("s", 4, 1, 1, 1)]


def test_weights(spark):
    df = spark.createDataFrame([("s", "a", 2.0), ("s", "b", 6.0), ("t", "a", 0.25), ("t", "b", 0.75)], "series_id string, location string, weight double")
    got = sorted(rows(normalise_weights(df)))
    assert got == [("s", "a", 0.25), ("s", "b", 0.75), ("t", "a", 0.25), ("t", "b", 0.75)]
    fixed = default_locations(spark)
    assert sorted(rows(normalise_weights(fixed, []))) == sorted(rows(fixed))


def test_missing_reading_counts_as_zero(spark):
    readings = spark.createDataFrame([("s", 1, "a", 10.0), ("s", 1, "b", None), ("s", 2, "b", None)], "series_id string, ts int, location string, v double")
    weights = spark.createDataFrame([("a", 0.4), ("b", 0.6)], "location string, weight double")
    plain = weighted_mean(readings, weights, values={"v": "v_avg"})
    assert sorted(rows(plain)) == [("s", 1, 4.0), ("s", 2, 0.0)]
    scaled = weighted_mean(readings, weights, values={"v": "v_avg"}, renormalise=True)
    assert sorted(rows(scaled)) == [("s", 1, 10.0), ("s", 2, None)]


def scores(spark, data):
    return spark.createDataFrame(data, "ts timestamp, predicted_price double, mode string, actual_price double").withColumn("abs_error", F.abs(F.col("actual_price") - F.col("predicted_price")))


def test_metrics_edges(spark):
    t = datetime(2024, 1, 1)
    df = scores(spark, [(t, 2.0, "x", 1.0), (t, 2.0, "x", 3.0), (t, 5.0, "x", None)])
    got = df.agg(*error_metrics()).first()
    assert (got.mae, got.rmse, got.r2) == (1.0, 1.0, 0.0)
    assert math.isclose(got.mape, (1 / 1 + 1 / 3) / 2 * 100)
    flat = scores(spark, [(t, 2.0, "x", 2.0), (t, 2.0, "x", 2.0)])
    assert flat.agg(*error_metrics()).first().r2 == 1.0
    off = scores(spark, [(t, 2.0, "x", 0.0), (t, 2.0, "x", 0.0)]).agg(*error_metrics()).first()
    assert off.r2 == 0.0 and off.mape > 1e10


def test_display_subset(spark):
    t = datetime(2024, 1, 1)
    both = scores(spark, [(t, 1.0, "backtest", 1.0), (t, 2.0, "forecast", None)])
    assert r.display_subset(both).count() == 1
    past = both.where("mode = 'backtest'")
    assert r.display_subset(past).count() == 1


def test_cheapest_hours_window_falls_back(spark):
    base = datetime(2024, 1, 1)
    data = [(base + timedelta(hours=h), float(10 - h % 7), "x", None) for h in range(48)]
    df = scores(spark, data)
    near = r.cheapest_hours_window(df, F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert near.count() == 4 and {x.ts.day for x in near.collect()} <= {1, 2}
    assert min(x.ts for x in near.collect()) >= base + timedelta(hours=12)
    late = r.cheapest_hours_window(df, F.lit("2024-01-02 22:00:00").cast("timestamp"))
    # only two rows are left, so all rows count; equal prices go by time
    assert [x.ts.hour + 24 * (x.ts.day - 1) for x in late.collect()] == [6, 13, 20, 27]


def test_histogram_edges(spark):
    t = datetime(2024, 1, 1)
    df = scores(spark, [(t, float(v), "x", None) for v in (0, 1, 10, 20)])
    assert sorted((x.bin, x.row_count) for x in r.price_histogram(df).collect()) == [(0, 1), (1, 1), (10, 1), (19, 1)]
    flat = scores(spark, [(t, 3.0, "x", None)] * 3)
    assert [(x.bin, x.row_count) for x in r.price_histogram(flat).collect()] == [(0, 3)]


def test_mode_label(spark):
    base = datetime(2024, 1, 10)
    df = spark.createDataFrame([(base + timedelta(days=d),) for d in (-8, -7, 0, 2, 3)], "ts timestamp")
    got = r.mode_label(df, F.lit("2024-01-10").cast("timestamp"), 7, 2)
    assert [x.mode for x in got.orderBy("ts").collect()] == ["backtest", "forecast", "forecast"]


def test_split_rows(spark):
    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", base + timedelta(hours=h)) for h in range(101)], "series_id string, ts timestamp")
    got = split_rows(df, F.lit("2024-01-04").cast("timestamp"), chunk_hours=10).orderBy("ts")
    labels = [x.split for x in got.collect()]
    assert labels == ["train"] * 61 + ["val"] * 11 + ["test"] * 29


def test_hash_split_is_repeatable(spark):
    df = spark.range(20000)
    a = rows(hash_split(df, ["id"]).where("split = 'test'").select("id"))
    b = rows(hash_split(df.repartition(7), ["id"]).where("split = 'test'").select("id"))
    assert sorted(a) == sorted(b) and 3600 < len(a) < 4400


def test_month_slices(spark):
    df = spark.createDataFrame([("2024-01-31", "2024-05-15"), ("2024-01-01", "2024-03-01"), ("2024-01-05", "2024-01-05")], "s string, e string")
    df = df.select(F.col("s").cast("date").alias("start_date"), F.col("e").cast("date").alias("end_date"))
    got = [(str(x.slice_start), str(x.slice_end)) for x in month_slices(df).orderBy("start_date", "slice_no").collect()]

    def model(start, end):
        current, end = pd.Timestamp(start), pd.Timestamp(end)
        while current < end:
            nxt = min(current + pd.DateOffset(months=1), end)
            yield str(current.date()), str(nxt.date())
            current = nxt

    want = [*model("2024-01-01", "2024-03-01"), *model("2024-01-31", "2024-05-15")]
    assert got == want
