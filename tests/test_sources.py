"""Documents, tables, predictions, streams and models on small own fixtures."""

import json
import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pricegrid.operators.reports import mode_label
from pricegrid.operators.splits import split_rows
from pricegrid.plans import boosting, ingest, jobs
from pricegrid.plans import models as m
from pricegrid.sources import documents as docs
from pricegrid.sources import predictions as preds
from pricegrid.sources import tables as t
from pricegrid.streaming import ingest as st


def rows(df):
    return sorted(tuple(x) for x in df.collect())


def document(body, ns='xmlns="urn:example:7:3"'):
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<Document {ns}>{body}</Document>'


def series(periods, psr=None):
    kind = f"<MktPSRType><psrType>{psr}</psrType></MktPSRType>" if psr else ""
    return f"<TimeSeries>{kind}{periods}</TimeSeries>"


def period(start, resolution, points, tag="quantity"):
    head = f"<timeInterval><start>{start}</start><end>x</end></timeInterval>" if start else ""
    res = f"<resolution>{resolution}</resolution>" if resolution else ""
    body = "".join(
        "<Point>"
        + (f"<position>{p}</position>" if p is not None else "")
        + (f"<{tag}>{v}</{tag}>" if v is not None else "")
        + "</Point>"
        for p, v in points
    )
    return f"<Period>{head}{res}{body}</Period>"


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)

    return put


def read_points(spark, *paths):
    return docs.points(docs.read_time_series(spark, list(paths)))


def stamp(df):
    return df.withColumn("ts", F.col("ts").cast("string"))


def test_prices(spark, write):
    body = (
        series(
            period("2026-01-04T23:00Z", "PT60M", [(1, 10.0), (3, -30.5)], "price.amount")
            + period("2026-01-05T01:00Z", "PT15M", [(1, 99.0), (2, 11.5)], "price.amount")
        )
        + series(period("2026-01-06T00:00Z", "P1D", [(2, 7.0)], "price.amount"))
    )
    got = rows(stamp(docs.price_rows(read_points(spark, write("p.xml", document(body))))))
    assert got == [
        ("2026-01-04 23:00:00", 10.0),
        ("2026-01-05 01:00:00", -30.5),  # first of two deliveries
        ("2026-01-05 01:15:00", 11.5),
        ("2026-01-06 01:00:00", 7.0),  # unlisted resolution counts as an hour
    ]


def test_documents_delivered_again_replace_the_earlier_ones(spark, write):
    hour = "2026-01-01T00:00Z"

    def doc(a, b):
        return document(series(period(hour, "PT60M", [(1, a), (1, b), (2, 9.0)]), "B18"))

    first, second = write("a.xml", doc(10.0, 4.0)), write("b.xml", doc(11.0, 5.0))
    os.utime(first, (1, 1))
    os.utime(second, (2, 2))
    wind = rows(stamp(docs.generation_rows(read_points(spark, first, second)).drop("solar_forecast")))
    assert wind == [("2026-01-01 00:00:00", 16.0), ("2026-01-01 01:00:00", 9.0)]
    load = rows(stamp(docs.load_rows(read_points(spark, first, second))))
    assert load == [("2026-01-01 00:00:00", 11.0), ("2026-01-01 01:00:00", 9.0)]


def test_documents_that_do_not_parse_are_told(spark, write):
    text = [("z", "<TimeSeries><Period><Point>", "f1", 1), ("z", series(period("2026-01-01T00:00Z", "PT60M", [(1, 1.0)])), "f2", 2)]
    df = spark.createDataFrame(text, "series_id string, doc string, file string, row long")
    parsed = docs.parse_time_series(df, "doc", "file", "row")
    assert [r["__file"] for r in docs.rejected_documents(parsed).collect()] == ["f1"]
    assert docs.points(parsed).count() == 1
    with pytest.raises(ValueError, match="no data in"):
        docs.required(docs.read_time_series(spark, write("broken.xml", "<a></a>")), "broken.xml")


def test_strict_resolution_goes_to_the_rejected(spark, write):
    body = series(
        period("2026-01-06T00:00Z", "P1D", [(2, 7.0)], "price.amount")
        + period("2026-01-06T00:00Z", "PT30M", [(2, 8.0)], "price.amount")
    )
    pts = read_points(spark, write("p.xml", document(body)))
    assert rows(stamp(docs.price_rows(pts, strict=True))) == [("2026-01-06 00:30:00", 8.0)]
    assert docs.rejected(pts, "price").count() == 1


@pytest.mark.parametrize("ns", ['xmlns="urn:example:3:0"', 'xmlns="urn:other:9:9"', ""])
def test_loads(spark, write, ns):
    body = series(
        period("2026-03-28T23:00Z", None, [(1, 5), (2, None), (None, 3), (4, 6)])
        + period(None, "PT60M", [(1, 77)])
        + period("2026-03-30T00:00Z", "PT30M", [(2, 8)])
    )
    got = rows(stamp(docs.load_rows(read_points(spark, write("l.xml", document(body, ns))))))
    assert got == [
        ("2026-03-28 23:00:00", 5.0),
        ("2026-03-29 02:00:00", 6.0),
        ("2026-03-30 00:15:00", 8.0),
    ]


def test_document_without_series(spark, write):
    pts = read_points(spark, write("e.xml", document("<note>none</note>")))
    assert docs.load_rows(pts).count() == 0


def test_generation(spark, write):
    hour = "2026-01-01T00:00Z"
    body = (
        series(period(hour, "PT60M", [(1, 1.0), (2, 5.0)]), "B16")
        + series(period(hour, "PT60M", [(1, 10.0), (1, 4.0)]), "B18")
        + series(period(hour, "PT60M", [(1, 100.0)]), "B19")
        + series(period(hour, "PT60M", [(1, 999.0)]), "B10")
        + series(period(hour, "PT60M", [(1, 999.0)]))
    )
    got = rows(stamp(docs.generation_rows(read_points(spark, write("g.xml", document(body))))))
    assert got == [("2026-01-01 00:00:00", 114.0, 1.0), ("2026-01-01 01:00:00", 0.0, 5.0)]


def weather(times, base):
    n = len(times)
    return json.dumps(
        {
            "hourly": {
                "time": times,
                "temperature_2m": [base + i for i in range(n)],
                "wind_speed_10m": [None] * n,
                "wind_speed_80m": [1.0] * n,
                "direct_normal_irradiance": [0.0] * n,
            }
        }
    )


def test_weather(spark, write):
    times = ["2026-03-29T01:00", "2026-03-29T03:00"]
    paths = [
        write(f"w/{name}.json", weather(times, base))
        for name, base in (("Stockholm", 1.0), ("Uppsala", 2.0), ("Västerås", 3.0), ("Norrköping", 4.0))
    ]
    readings = docs.read_weather(spark, paths)
    assert {x.location for x in readings.collect()} == {"Stockholm", "Uppsala", "Västerås", "Norrköping"}
    got = ingest.weather_table(readings, docs.default_locations(spark), ["ts"])
    picked = stamp(got).select("ts", F.round("temperature_avg", 6), "wind_speed_10m_avg")
    assert rows(picked) == [("2026-03-29 00:00:00", 2.2, 0.0), ("2026-03-29 01:00:00", 3.2, 0.0)]


def test_weather_deliveries_and_repeated_hour(spark, write):
    night = ["2024-10-27T01:00", "2024-10-27T02:00", "2024-10-27T02:00", "2024-10-27T03:00"]
    first = write("w1/Stockholm.json", weather(night, 50.0))
    os.utime(first, (1, 1))
    paths = [first, write("w2/Stockholm.json", weather(night, 10.0)), write("w2/Uppsala.json", weather(night[1:2] + night[3:], 3.0)),
             write("w2/Torn.json", weather(night, 0.0)[:60]), write("w2/Empty.json", "{}")]
    readings = docs.read_weather(spark, paths)
    got = stamp(readings).select("location", "ts", "temperature_2m")
    assert rows(got) == [
        ("Stockholm", "2024-10-26 23:00:00", 10.0), ("Stockholm", "2024-10-27 00:00:00", 11.0),
        ("Stockholm", "2024-10-27 01:00:00", 12.0), ("Stockholm", "2024-10-27 02:00:00", 13.0),
        ("Uppsala", "2024-10-27 02:00:00", 4.0),  # its single 02:00 may be either
    ]
    bad = docs.rejected_weather(docs.read_weather_documents(spark, paths)).collect()
    assert {r.location for r in bad} == {"Torn", "Empty"}
    assert [bool(r["__broken"]) for r in bad if r.location == "Torn"] == [True]


def test_backfill_from_files(spark, write, tmp_path):
    start = "2026-01-30T23:00Z"
    hours = range(1, 73)

    def doc(tag, psr=None, skip=()):
        points = [(p, float(p)) for p in hours if p not in skip]
        return document(series(period(start, "PT60M", points, tag), psr))

    market = ingest.read_market(
        spark,
        write("z1/price.xml", doc("price.amount", skip=(5, 6))),
        write("z1/load.xml", doc("quantity", skip=(1, 2))),
        write("z1/gen.xml", doc("quantity", "B16")),
        series_pattern=r"([^/]+)/[^/]+$",
        zone=None,
    )
    first = datetime(2026, 1, 31)
    times = [(first + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(72)]
    readings = docs.read_weather(spark, write("w/Stockholm.json", weather(times, 0.0)))
    forecast = ingest.weather_table(readings, docs.default_locations(spark), ["ts"]).withColumn("series_id", F.lit("z1"))
    paths = [str(tmp_path / "market_v4"), str(tmp_path / "weather_v4")]
    ingest.backfill(market, forecast, *paths)
    stored = spark.read.parquet(paths[0])
    assert stored.count() == 72 and {r[0] for r in stored.select("series_id").distinct().collect()} == {"z1"}
    assert {r[0] for r in stored.select("part_month").distinct().collect()} == {"2026-01", "2026-02"}
    assert stored.where("price is null or load_forecast is null").count() == 0
    joined = t.read_groups(spark, *paths)
    assert joined.count() == 72 and set(joined.columns) >= {"temperature_avg", "price"}
    # the daily job delivers two of the days again, with one new price
    again = market.where("ts >= '2026-01-31 23:00:00'").withColumn(
        "price", F.when(F.col("ts") == "2026-02-01 23:00:00", 500.0).otherwise(F.col("price"))
    )
    jobs.daily_update(again, forecast, *paths, as_of="2026-02-02 13:30:00")
    after = spark.read.parquet(paths[0])
    assert after.count() == 72
    assert after.where("ts = '2026-02-01 23:00:00'").first().price == 500.0


def price_rows(spark, months, version=1):
    data = [(f"z{s}", datetime(2024, mth, 1) + timedelta(hours=h), float(s * 100 + h), version) for s in range(2) for mth in months for h in range(30)]
    return spark.createDataFrame(data, "series_id string, ts timestamp, price double, ingest_ts int")


def test_months_are_replaced_alone_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t_v1")
    t.write_months(price_rows(spark, (1, 2, 3)), path)
    t.write_months(price_rows(spark, (2,), version=9), path)
    got = spark.read.parquet(path)
    assert got.count() == 180 and got.where("ingest_ts = 9").count() == 60
    part = t.read_months(spark, path, "2024-02-01 10:00:00", "2024-02-01 12:00:00")
    assert part.count() == 6
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part_month" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert t.read_months(spark, path, months=["2024-03"]).count() == 60


def test_upsert_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "u_v1")
    t.upsert(price_rows(spark, (1, 2)), path)
    late = price_rows(spark, (2, 3), version=2).withColumn("price", -F.col("price"))
    for _ in range(2):
        t.upsert(late, path)
    got = spark.read.parquet(path)
    assert got.count() == 180
    assert got.where("ingest_ts = 2").count() == 120 and got.where("price > 0 and ingest_ts = 2").count() == 0
    t.upsert(price_rows(spark, (3,), version=1), path)  # an older version changes nothing
    assert spark.read.parquet(path).where("ingest_ts = 2").count() == 120


def test_upsert_into_a_table_stored_without_versions(spark, tmp_path):
    path = str(tmp_path / "v_v1")
    t.write_months(price_rows(spark, (1,)).drop("ingest_ts"), path)
    later = price_rows(spark, (1,)).where("hour(ts) >= 12").withColumn("price", F.lit(-1.0))
    t.upsert(later, path)
    got = spark.read.parquet(path)
    assert got.count() == 60 and got.where("price IS NULL").count() == 0
    assert got.where("price = -1").count() == later.count()
    again = later.withColumn("price", F.lit(-2.0))  # the same version delivered again
    t.upsert(again, path)
    assert spark.read.parquet(path).where("price = -2").count() == later.count()
    t.upsert(later.drop("ingest_ts"), path)  # without a version it is older than any
    assert spark.read.parquet(path).where("price = -2").count() == later.count()


def test_month_pairing(spark):
    a = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-02",)], "part_month string")
    b = spark.createDataFrame([("2024-02",), ("2024-03",)], "part_month string")
    assert rows(t.pair_months(a, b)) == [("2024-02", 2, 1)]


def test_predictions(spark, write, tmp_path):
    records = [
        {"timestamp": "2026-01-05 17:00:00+00:00", "predicted_price": 2.0, "mode": "forecast", "actual_price": None, "error": None, "abs_error": None},
        {"timestamp": "2026-01-05 16:00:00+00:00", "predicted_price": 1.0, "mode": "backtest", "actual_price": 3.0, "error": 2.0, "abs_error": 2.0},
    ]
    df = preds.read_predictions(spark, write("latest.json", json.dumps(records, indent=2)))
    assert [x.predicted_price for x in df.collect()] == [1.0, 2.0]
    root = str(tmp_path / "runs")
    preds.write_predictions(df.where("mode = 'backtest'"), root, "20260105_100000")
    preds.write_predictions(df, root, "20260106_100000")
    latest = preds.latest_predictions(spark, root)
    assert rows(stamp(latest).select("ts", "predicted_price", "actual_price")) == [
        ("2026-01-05 16:00:00", 1.0, 3.0),
        ("2026-01-05 17:00:00", 2.0, None),
    ]


def test_stream_windows_close_with_the_watermark(spark, tmp_path):
    path = str(tmp_path / "landing")
    for i, (day, n) in enumerate(((1, 3), (5, 2))):
        data = [(i * 10 + k, datetime(2024, 1, day, 0, k), 1.0) for k in range(n)]
        spark.createDataFrame(data, "event_id int, ts timestamp, value double").coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    totals = st.hourly_totals(st.landed_rows(spark, path, schema, files_per_batch=1), [], "value")
    st.append_stream(totals, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert rows(stamp(spark.read.parquet(str(tmp_path / "out"))).select("ts", "row_count")) == [("2024-01-01 00:00:00", 3)]


def test_stream_restart_reads_only_new_files(spark, tmp_path):
    landing, table, progress = (str(tmp_path / n) for n in ("landing", "table", "progress"))
    price_rows(spark, (1,)).write.parquet(f"{landing}/d=1")
    schema = price_rows(spark, (1,)).schema

    def run():
        st.upsert_stream(st.landed_rows(spark, f"{landing}/*", schema), table, progress).awaitTermination()
        return spark.read.parquet(table)

    assert run().count() == 60
    price_rows(spark, (1, 2), version=2).write.parquet(f"{landing}/d=2")
    again = run()
    assert again.count() == 120 and again.where("ingest_ts = 2").count() == 120


@pytest.fixture(scope="module")
def market(spark):
    hours = spark.range(0, 24 * 30).select(
        F.lit("z").alias("series_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("ts"),
        (F.lit(50) + 20 * F.sin(F.col("id") * 3.14159 / 12) + F.pmod(F.col("id") * 7919, F.lit(11))).alias("price"),
        (F.lit(100.0) + F.pmod(F.col("id") * 31, F.lit(17))).alias("load_forecast"),
        F.pmod(F.col("id") * 13, F.lit(7)).cast("double").alias("wind_forecast"),
        F.pmod(F.col("id"), F.lit(24)).cast("double").alias("solar_forecast"),
    )
    return hours


def test_train_score_save(spark, market, tmp_path):
    out = jobs.train_job(
        market, "2024-01-25 00:00:00", str(tmp_path / "models"), str(tmp_path / "runs"), "price_model", 1,
        maxIter=5, maxDepth=3,
    )
    runs = spark.read.parquet(str(tmp_path / "runs"))
    row = m.best_run(runs).first()
    assert row.version == 1 and row.feature_count == len(m.model_inputs(out)) and row.training_samples > 400
    assert row.test_mae < 12
    model = m.load_model(str(tmp_path / "models"), "price_model", 1)
    assert m.model_inputs(model) == m.model_inputs(out)
    assert "price_diff_1h" not in m.model_inputs(model) and "price" not in m.model_inputs(model)
    scored = jobs.score_job(market, model, "2024-01-25 00:00:00", str(tmp_path / "predictions"), "r1")
    assert {x.mode for x in scored.select("mode").distinct().collect()} == {"backtest", "forecast"}
    assert scored.count() == 24 * 9 + 1 and scored.where("abs_error is null").count() == 0
    assert preds.latest_predictions(spark, str(tmp_path / "predictions")).count() == 24 * 9 + 1
    top = m.importance(model, spark).collect()
    assert len(top) == 10 and [x.importance for x in top] == sorted((x.importance for x in top), reverse=True)


def test_boost_score_save(spark, market, tmp_path):
    settings = replace(boosting.LEVEL_WISE, rounds=6, rate=0.4, depth=3)
    nodes = jobs.boost_job(
        market, "2024-01-25 00:00:00", str(tmp_path / "models"), str(tmp_path / "runs"), "boosted", 3, settings
    )
    row = m.newest_run(spark.read.parquet(str(tmp_path / "runs")), "boosted").first()
    assert row.version == 3 and row.training_samples > 400 and row.val_mae < 12
    stored = boosting.load_nodes(spark, str(tmp_path / "models"), "boosted", 3)
    assert sorted(map(str, stored.collect())) == sorted(map(str, nodes.collect()))
    assert "price_diff_1h" not in {r.feature for r in stored.collect()}
    scored = jobs.score_job(market, stored, "2024-01-25 00:00:00", str(tmp_path / "predictions"), "r1")
    assert scored.count() == 24 * 9 + 1 and scored.where("abs_error is null").count() == 0


def test_other_families(spark, market):
    rows_ = split_rows(market, F.lit("2024-01-25").cast("timestamp"))
    for family, params in (("forest", {"numTrees": 5, "maxDepth": 4}), ("linear", {})):
        model = m.train(rows_, family=family, **params)
        assert m.score(rows_, model, ["ts"]).count() == 720
    with pytest.raises(ValueError):
        m.learner("other")


def test_align_adds_absent_features(spark):
    df = spark.createDataFrame([(1, None)], "b int, a double")
    assert rows(m.align_features(df, ["a", "c", "b"])) == [(0.0, 0.0, 1.0)]


def test_training_matrix(spark):
    df = spark.createDataFrame(
        [("z", datetime(2024, 1, 1), 1.0, None, 2, "x"), ("z", datetime(2024, 1, 2), None, 1.0, 2, "x")],
        "series_id string, ts timestamp, price double, a double, b int, note string",
    )
    got = m.training_matrix(df)
    assert got.columns == ["series_id", "ts", "a", "b", "price"]
    assert [(x.a, x.b, x.price) for x in got.collect()] == [(0.0, 2.0, 1.0)]


def test_mode_of_scored_rows(spark, market):
    got = mode_label(market, F.lit("2024-01-25").cast("timestamp"))
    assert got.where("mode = 'forecast'").count() == 24 * 6
