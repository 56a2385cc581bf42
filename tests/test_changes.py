"""Refreshed features equal a full run; late rows correct hours, repeated batches count once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pricegrid.plans import jobs, refresh
from pricegrid.plans.features import engineer_on_grid
from pricegrid.plans.ingest import BACKFILL_VERSION
from pricegrid.schemas import BATCH, MONTH
from pricegrid.sources import tables as t
from pricegrid.streaming import ingest as st
from pricegrid.streaming import late

START = datetime(2024, 1, 1, 0, 30)
MARKET = "series_id string, ts timestamp, price double, load_forecast double, wind_forecast double, solar_forecast double"


def market(spark, hours, series=("a", "b"), holes=0.1, seed=1):
    rng = random.Random(seed)
    data = [(s, START + timedelta(hours=h), rng.uniform(0, 90), 10.0 + h % 24, 2.0, 1.0)
            for s in series for h in range(hours) if h == 0 or rng.random() > holes]
    return spark.createDataFrame(data, MARKET)


def content(df, columns):
    shown = [F.round(c, 8).alias(c) if kind == "double" else F.col(c) for c, kind in df.select(*columns).dtypes]
    return sorted(map(repr, df.select(*shown).collect()))


def test_refresh_equals_a_full_run_and_reads_reached_months_only(spark, tmp_path):
    source, features = str(tmp_path / "market_v1"), str(tmp_path / "features_v1")
    rows = market(spark, 24 * 150)
    t.write_months(rows, source)
    t.write_months(t.as_double(engineer_on_grid(rows)), features)
    # series a: two changes far apart, series b: one at a month's end
    hit = "(series_id = 'a' AND ts IN ('2024-01-03 04:30:00', '2024-04-10 00:30:00')) OR (series_id = 'b' AND ts >= '2024-04-30 22:30:00' AND ts < '2024-05-01 01:00:00')"
    corrected = rows.withColumn("price", F.when(F.expr(hit), F.col("price") - 1000).otherwise(F.col("price")))
    changed = refresh.changed_instants(corrected, t.read_months(spark, source))
    assert 2 <= changed.count() <= 5
    asked = []

    def read(months):
        asked.extend(months)
        return t.read_months(spark, source, months=months).drop(MONTH, "ingest_ts")

    refresh.note_changes(changed, features)
    t.upsert(corrected, source)
    stamp = F.lit("2024-06-01").cast("timestamp")
    got = refresh.refresh(refresh.pending_changes(spark, features), read, features, stamp)
    # from a week before a change to a week after it; February and March lie between
    assert got == asked == ["2023-12", "2024-01", "2024-04", "2024-05"]
    after = spark.read.parquet(features)
    want = t.as_double(engineer_on_grid(corrected))
    columns = [c for c in want.columns if c != MONTH]
    assert content(after, columns) == content(want, columns)
    touched = {(r.series_id, r.d) for r in after.where("ingest_ts IS NOT NULL").select("series_id", F.to_date("ts").cast("string").alias("d")).collect()}
    assert ("a", "2024-01-03") in touched and ("a", "2024-01-10") in touched and ("a", "2024-01-11") not in touched
    assert ("a", "2024-01-02") not in touched and ("b", "2024-05-08") in touched and ("b", "2024-04-29") not in touched
    refresh.forget_changes(spark, features)
    assert refresh.pending_changes(spark, features) is None


def test_changes_of_odd_rows(spark):
    stored = spark.createDataFrame([("a", START, 1.0, None), ("a", START + timedelta(hours=1), 2.0, 3.0), (None, START, 5.0, 5.0)],
                                   "series_id string, ts timestamp, price double, load double")
    rows = [
        ("a", START, 1.0, None, "x"),  # the same, null is null
        ("a", START + timedelta(hours=1), 2.0, None, "x"),  # a value that is gone
        ("a", START + timedelta(hours=1), 2.0, 3.0, "x"),  # the same key as stored
        (None, START, 5.0, 5.0, "x"),  # a null series is a series
        ("b", START, None, None, "x"),  # new, though without values
        ("b", None, 1.0, 1.0, "x"),  # without an instant it reaches nothing
    ]
    delivery = spark.createDataFrame(rows, "series_id string, ts timestamp, price double, load double, extra string")
    got = {(r.series_id, r.ts) for r in refresh.changed_instants(delivery, stored).collect()}
    assert got == {("a", START + timedelta(hours=1)), ("b", START), ("b", None)}
    assert refresh.changed_instants(delivery, None).count() == 5
    days = refresh.reached_days(refresh.changed_instants(delivery, stored)).collect()
    assert len(days) == 30 and sum(r["__reached"] for r in days) == 16
    assert {r.series_id for r in days} == {"a", "b"}


def test_no_change_reads_and_writes_nothing(spark, tmp_path):
    rows = market(spark, 30)
    none = refresh.changed_instants(rows, rows)
    assert refresh.refresh(none, pytest.fail, str(tmp_path / "f"), F.lit(None)) == []
    assert not (tmp_path / "f").exists()


def test_daily_refresh_takes_up_what_a_dead_run_left(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / n) for n in ("market_v1", "weather_v1")]
    features = str(tmp_path / "features_v1")
    start = datetime(2024, 1, 1)
    price = [("a", start + timedelta(hours=h), 30.0 + h % 24 + h / 100, 10.0, 2.0, 1.0) for h in range(24 * 20)]
    sky = [("a", start + timedelta(hours=h), 5.0 + h % 7, 3.0, 4.0, 9.0) for h in range(24 * 20)]
    columns = "temperature_avg double, wind_speed_10m_avg double, wind_speed_80m_avg double, irradiance_avg double"
    prices = spark.createDataFrame(price, MARKET).withColumn(BATCH, F.date_format("ts", "yyyy-MM"))
    weather = spark.createDataFrame(sky, f"series_id string, ts timestamp, {columns}")

    def run(market_rows, weather_rows, as_of):
        return jobs.daily_refresh(market_rows, weather_rows, *paths, features, as_of)

    assert run(prices, weather, BACKFILL_VERSION) == ["2023-12", "2024-01"]
    assert spark.read.parquet(features).count() == 480
    new = prices.where("ts >= '2024-01-15'").withColumn(
        "price", F.when(F.col("ts") == "2024-01-16 05:00:00", 31.5).otherwise(F.col("price"))
    )
    sky = weather.where("ts >= '2024-01-15'")
    with monkeypatch.context() as patched:
        patched.setattr(refresh, "refresh", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(new, sky, "2024-02-01 00:00:00")
    assert spark.read.parquet(paths[0]).where("price = 31.5").count() == 1
    assert spark.read.parquet(features).where("price = 31.5").count() == 0
    run(new, sky, "2024-02-02 00:00:00")  # delivers what is stored by now
    got = spark.read.parquet(features)
    assert got.where("price = 31.5 OR price_lag_24h = 31.5 OR price_lag_168h = 31.5").count() >= 2
    joined = t.read_groups(spark, *paths).drop("ingest_ts", MONTH)
    want = t.as_double(engineer_on_grid(joined.drop("ingest_ts")))
    same = [c for c in want.columns if c not in (MONTH, "ingest_ts")]
    assert content(got, same) == content(want, same)
    assert run(new, sky, "2024-02-03 00:00:00") == []  # nothing has changed


def land(spark, landing, number, data):
    frame = spark.createDataFrame(data, "zone string, ts timestamp, value double")
    frame.coalesce(1).write.parquet(f"{landing}/d={number}")
    return frame.schema


def test_late_rows_correct_emitted_hours(spark, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    day = datetime(2024, 1, 10)
    batches = [
        [("z", day, 1.0), ("z", day + timedelta(minutes=5), 2.0)],
        # 8 January is late, the last hour before the mark is not over, null has no hour
        [("z", day - timedelta(days=2), 4.0), ("z", day - timedelta(days=1), 8.0), ("z", None, 16.0), (None, day, 32.0)],
        [("z", day - timedelta(days=2), 64.0), ("z", day + timedelta(days=3), 128.0)],
        [("z", day, 256.0)],  # emitted by now
    ]

    def run():
        rows = st.landed_rows(spark, f"{landing}/*", schema, files_per_batch=1)
        late.corrected_totals(rows, ["zone"], "value", out, progress).awaitTermination()

    for number, data in enumerate(batches):
        schema = land(spark, landing, number, data)
        run()
    run()  # nothing new

    def state():
        return {(r.zone, r.ts): (r.row_count, r.total, r.late_rows, r.late_total) for r in late.totals(spark, out, ["zone"]).collect()}

    want = {
        ("z", day): (3, 259.0, 1, 256.0),
        (None, day): (1, 32.0, 0, None),
        ("z", day - timedelta(days=2)): (2, 68.0, 2, 68.0),
        ("z", day - timedelta(days=1)): (1, 8.0, 0, None),
        ("z", day + timedelta(days=3)): (1, 128.0, 0, None),
    }
    assert state() == want
    kept = late.late_rows(spark, out)
    assert sorted((r.batch, r.value) for r in kept.collect()) == [(1, 4.0), (1, 16.0), (2, 64.0), (3, 256.0)]
    # a batch that runs again after a failure replaces what it wrote
    for number in (1, 2, 3):
        frame = spark.createDataFrame(batches[number], "zone string, ts timestamp, value double")
        late._add(frame, number, ["zone"], "value", out, "ts", "1 day")
    assert state() == want
    assert late.late_rows(spark, out).count() == 4
    part = late.totals(spark, out, ["zone"], "2024-01-09 00:00:00", "2024-01-09 23:00:00")
    assert part.count() == 1
