"""Documents, monthly tables, upsert, views, incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.features import FULL_COLS, FULL_SQL, KEYS, MARKET, WEATHER, full_features_of
from pricegrid.catalog.registry import query, rounded, twin
from pricegrid.functions.timezones import utc_to_local
from pricegrid.operators.market import join_market
from pricegrid.operators.quality import outlier_clip
from pricegrid.plans.ingest import market_table
from pricegrid.session import fresh_path
from pricegrid.sources import documents as docs
from pricegrid.sources import predictions as preds
from pricegrid.sources import tables as t
from pricegrid.sources import versions
from pricegrid.streaming import ingest as st

ORDERS = """SELECT o_custkey AS series_id, o_orderkey, o_orderdate AS ts, round(o_totalprice + 0.000000001::DOUBLE, 6) + 0.0 AS price,
      strftime(o_orderdate, '%Y-%m') AS part_month FROM orders"""


def _orders(spark, sf):
    return v.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("series_id"),
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("price"),
    )


@query("month_roundtrip", ORDERS)
def _month_roundtrip(spark, sf):
    path = t.table_path(fresh_path(spark, "months"), "orders", 1)
    t.write_months(_orders(spark, sf), path)
    return t.read_months(spark, path)


@query(
    "month_range",
    f"""SELECT * FROM ({ORDERS}) WHERE ts >= TIMESTAMP '1997-03-10 00:00:00'
      AND ts <= TIMESTAMP '1998-02-20 00:00:00'""",
)
def _month_range(spark, sf):
    path = t.table_path(fresh_path(spark, "months"), "orders", 1)
    t.write_months(_orders(spark, sf), path)
    return t.read_months(spark, path, "1997-03-10 00:00:00", "1998-02-20 00:00:00")


@query(
    "month_pairing",
    """SELECT part_month, market_rows, weather_rows FROM
      (SELECT strftime(o_orderdate, '%Y-%m') AS part_month, count(*) AS market_rows FROM orders GROUP BY ALL)
      JOIN (SELECT strftime(l_shipdate, '%Y-%m') AS part_month, count(*) AS weather_rows FROM lineitem GROUP BY ALL)
      USING (part_month)""",
)
def _month_pairing(spark, sf):
    orders = t.with_month(v.table(spark, sf, "orders").select(F.col("o_orderdate").alias("ts")))
    items = t.with_month(v.table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("ts")))
    return t.pair_months(orders, items)


@query(
    "upsert_latest",
    """SELECT o_custkey AS series_id, o_orderkey, o_orderdate AS ts,
      round(CASE WHEN o_orderdate >= TIMESTAMP '1998-01-15' THEN o_totalprice * 2 ELSE o_totalprice END, 6)
        + 0.0 AS price,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-15' THEN 2 ELSE 1 END AS version,
      strftime(o_orderdate, '%Y-%m') AS part_month FROM orders""",
)
def _upsert_latest(spark, sf):
    rows = _orders(spark, sf)
    first = rows.where("ts < '1999-07-01'").withColumn("version", F.lit(1))
    second = (
        rows.where("ts >= '1998-01-15'")
        .withColumn("price", F.col("price") * 2)
        .withColumn("version", F.lit(2))
    )
    path = t.table_path(fresh_path(spark, "upsert"), "orders", 1)
    for delivery in (first, second, second):
        t.upsert(delivery, path, ("series_id", "o_orderkey", "ts"), "version")
    return spark.read.parquet(path)


@query(
    "published_versions",
    """WITH r AS (SELECT o_custkey AS series_id, o_orderkey, o_orderdate AS ts, o_totalprice AS price,
      strftime(o_orderdate, '%Y-%m') AS part_month FROM orders),
    first AS (SELECT 1 AS version, * FROM r WHERE ts < TIMESTAMP '1997-07-10'),
    second AS (SELECT 2 AS version, * REPLACE (CASE WHEN ts >= TIMESTAMP '1997-06-20' THEN price * 2 ELSE price END
      AS price) FROM r WHERE ts < TIMESTAMP '1997-08-05')
    SELECT version, part_month, count(*) AS row_count, round(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE)
      + 0.000000001::DOUBLE, 6) + 0.0 AS total
    FROM (SELECT * FROM first UNION ALL SELECT * FROM second) GROUP BY ALL""",
)
def _published_versions(spark, sf):
    # The first version is opened before the update and read after it.
    rows = _orders(spark, sf)
    path = t.table_path(fresh_path(spark, "published"), "orders", 1)
    versions.create(spark, path)
    key = ("series_id", "o_orderkey", "ts")
    stamp = F.lit("1997-08-05").cast("timestamp")
    t.upsert(rows.where("ts < '1997-07-10'"), path, key)
    before = t.read_months(spark, path)
    later = rows.where("ts >= '1997-06-20' AND ts < '1997-08-05'")
    t.upsert(later.withColumn("price", F.col("price") * 2).withColumn("ingest_ts", stamp), path, key)
    both = [before, t.read_months(spark, path)]
    both = [b.select(F.lit(n).alias("version"), "part_month", "price") for n, b in enumerate(both, 1)]
    money = F.sum(F.col("price").cast("decimal(18,2)")).cast("double")
    return both[0].unionByName(both[1]).groupBy("version", "part_month").agg(
        F.count(F.lit(1)).alias("row_count"), money.alias("total")
    )


RANGE = ("2024-01-05 06:00:00", "2024-01-20 18:00:00")
RANGE_WHERE = f"ts >= TIMESTAMP '{RANGE[0]}' AND ts <= TIMESTAMP '{RANGE[1]}'"
INNER_SQL = f"""{v.ZONE_SQL}, {v.WEATHER_SQL},
    joined AS (SELECT m.*, w.* EXCLUDE (series_id, ts) FROM market_zone m
      JOIN weather_zone w ON m.series_id = w.series_id AND m.ts = w.ts)"""


@query(
    "fg_range_join", twin(f"{KEYS}, {MARKET}, {WEATHER}", "joined", INNER_SQL, where=RANGE_WHERE)
)
def _fg_range_join(spark, sf):
    root = fresh_path(spark, "groups")
    market, weather = t.table_path(root, "market", 4), t.table_path(root, "weather", 4)
    t.write_months(v.market_zone(spark, sf), market)
    t.write_months(v.weather_zone(spark, sf), weather)
    return t.read_groups(spark, market, weather, *RANGE).drop("part_month")


@query("feature_view", twin(f"{KEYS}, {MARKET}, {WEATHER}", "joined", INNER_SQL, where=RANGE_WHERE))
def _feature_view(spark, sf):
    joined = v.market_zone(spark, sf).join(v.weather_zone(spark, sf), ["series_id", "ts"])
    t.feature_view(joined, "price_view")
    return t.read_view(spark, "price_view", *RANGE)


def doubled(columns: str) -> str:
    """Every column but the keys as a rounded double, as in the store."""
    out = ["series_id", "ts"]
    for c in columns.split(","):
        c = c.strip().lstrip("~")
        if c not in ("series_id", "ts"):
            out.append(rounded(f"CAST({c} AS DOUBLE)", c))
    return ", ".join(out)


@query("engineered_table", f"WITH {FULL_SQL} SELECT {doubled(FULL_COLS)} FROM full_features")
def _engineered_table(spark, sf):
    path = t.table_path(fresh_path(spark, "engineered"), "features", 2)
    rows = t.as_double(full_features_of(spark, sf)).withColumn("version", F.lit(1))
    t.upsert(rows, path, version_col="version")
    return spark.read.parquet(path).drop("part_month", "version")


# One document per series and day, written as text by Spark from the events and
# read back through the document sources.


def _documents(spark, sf, types, value_tag, with_type=False):
    rows = v.events(spark, sf)
    if types:
        rows = rows.where(F.col("event_type").isin(types))
    keys = ["series_id", F.to_date("hour_ts").alias("day")]
    if with_type:
        kind = (
            F.when(F.col("event_type") == "click", "B16")
            .when(F.col("event_type") == "view", "B18")
            .when(F.col("event_type") == "signup", "B19")
            .otherwise("B01")
        )
        keys.append(kind.alias("psr"))
    # At most one point per hour, so a document is bounded by its day.
    hourly = rows.groupBy(*keys, (F.hour("hour_ts") + 1).alias("position")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("value")
    )
    group = ["series_id", "day"] + (["psr"] if with_type else [])
    point = F.concat(
        F.lit("<Point><position>"), F.col("position"), F.lit(f"</position><{value_tag}>"),
        F.col("value"), F.lit(f"</{value_tag}></Point>"),
    )
    body = F.concat_ws("", F.array_sort(F.collect_list(point)))
    head = [F.lit("<TimeSeries>")]
    if with_type:
        head += [F.lit("<MktPSRType><psrType>"), F.col("psr"), F.lit("</psrType></MktPSRType>")]
    start = F.concat(F.col("day").cast("string"), F.lit("T00:00Z"))
    return (
        hourly.groupBy(*group)
        .agg(body.alias("points"))
        .select(
            *group,
            F.concat(
                *head,
                F.lit("<Period><timeInterval><start>"), start,
                F.lit("</start></timeInterval><resolution>PT60M</resolution>"),
                "points",
                F.lit("</Period></TimeSeries>"),
            ).alias("doc"),
            F.lit("events").alias("file"),
            F.datediff("day", F.lit("1970-01-01").cast("date")).alias("row"),
        )
    )


def _hour_sums(types: str, name: str) -> str:
    return f"""SELECT user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS ts,
      round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 6) + 0.0 AS {name}
    FROM events WHERE event_type IN ({types}) GROUP BY ALL"""


def _points(spark, sf, types, tag, with_type=False):
    text = _documents(spark, sf, types, tag, with_type)
    return docs.points(docs.parse_time_series(text, "doc", "file", "row"))


@query("price_documents", _hour_sums("'purchase'", "price"))
def _price_documents(spark, sf):
    return docs.price_rows(_points(spark, sf, ["purchase"], "price.amount"))


@query("load_documents", _hour_sums("'purchase', 'error'", "load_forecast"))
def _load_documents(spark, sf):
    return docs.load_rows(_points(spark, sf, ["purchase", "error"], "quantity"))


@query(
    "generation_documents",
    f"""SELECT user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS ts,
      round(coalesce(sum(CASE WHEN event_type IN ('view', 'signup') THEN value END), 0), 6) + 0.0 AS wind_forecast,
      round(coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0), 6) + 0.0 AS solar_forecast
    FROM events WHERE event_type IN ('view', 'signup', 'click') GROUP BY ALL""",
)
def _generation_documents(spark, sf):
    return docs.generation_rows(_points(spark, sf, None, "quantity", with_type=True))


@query(
    "market_documents",
    f"""WITH p AS ({_hour_sums("'purchase'", "price")}),
    l AS ({_hour_sums("'purchase', 'error'", "load_forecast")}),
    g AS (SELECT user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS ts,
      round(coalesce(sum(CASE WHEN event_type IN ('view', 'signup') THEN value END), 0), 6) + 0.0 AS wind_forecast,
      round(coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0), 6) + 0.0 AS solar_forecast
      FROM events WHERE event_type IN ('view', 'signup', 'click') GROUP BY ALL)
    SELECT p.series_id, p.ts, price, load_forecast, wind_forecast, solar_forecast FROM p
    LEFT JOIN l ON p.series_id = l.series_id AND p.ts = l.ts
    LEFT JOIN g ON p.series_id = g.series_id AND p.ts = g.ts""",
)
def _market_documents(spark, sf):
    return join_market(
        docs.price_rows(_points(spark, sf, ["purchase"], "price.amount")),
        docs.load_rows(_points(spark, sf, ["purchase", "error"], "quantity")),
        docs.generation_rows(_points(spark, sf, None, "quantity", with_type=True)),
    )


@query(
    "weather_documents",
    twin(
        "series_id, location, ts, ~temperature_2m, ~wind_speed_10m, ~wind_speed_80m, ~irradiance",
        """(SELECT * REPLACE (timezone('UTC', timezone('Europe/Stockholm', ts)) AS ts)
          FROM weather_readings)""",
        v.READINGS_SQL,
    ),
)
def _weather_documents(spark, sf):
    # Readings taken as local hours; one document per series, location and month.
    return docs.parse_weather(_weather_texts(t.with_month(v.weather_readings(spark, sf)), "ts"), "doc")


def _weather_texts(readings, time_col):
    """One document per series, location and month, its hours in the order of ``ts``."""
    hour = F.struct(
        "ts",
        F.date_format(time_col, "yyyy-MM-dd'T'HH:mm").alias("time"),
        "temperature_2m", "wind_speed_10m", "wind_speed_80m",
        F.col("irradiance").alias("direct_normal_irradiance"),
    )
    fields = ["time", "temperature_2m", "wind_speed_10m", "wind_speed_80m", "direct_normal_irradiance"]
    hours = readings.groupBy("series_id", "location", "part_month").agg(F.array_sort(F.collect_list(hour)).alias("h"))
    hourly = F.struct(*[F.col(f"h.{c}").alias(c) for c in fields]).alias("hourly")
    return hours.select("series_id", "location", "part_month", F.to_json(F.struct(hourly)).alias("doc"))


# Readings moved into autumn, so that the repeated night of 27 October is among them.
AUTUMN_DAYS = 285


@query(
    "weather_deliveries",
    twin(
        "series_id, location, ts, ~temperature_2m, ~wind_speed_10m, ~wind_speed_80m, ~irradiance",
        f"""(SELECT * REPLACE (ts + INTERVAL {AUTUMN_DAYS} DAY AS ts), count(*) OVER (PARTITION BY series_id, location,
            CASE WHEN ts + INTERVAL {AUTUMN_DAYS} DAY IN (TIMESTAMP '2024-10-27 00:00:00', TIMESTAMP '2024-10-27 01:00:00')
              THEN TIMESTAMP '2024-10-27 00:00:00' ELSE ts + INTERVAL {AUTUMN_DAYS} DAY END) AS nights FROM weather_readings)""",
        v.READINGS_SQL,
        where="nights = 2 OR ts NOT IN (TIMESTAMP '2024-10-27 00:00:00', TIMESTAMP '2024-10-27 01:00:00')",
    ),
)
def _weather_deliveries(spark, sf):
    """Documents in local time with the repeated hour, delivered twice, and broken ones."""
    moved = v.weather_readings(spark, sf).withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(AUTUMN_DAYS)))
    local = t.with_month(moved).withColumn("local", utc_to_local("ts"))
    texts = _weather_texts(local, "local")
    wrong = _weather_texts(local.withColumn("temperature_2m", F.col("temperature_2m") + 5), "local")
    broken = texts.withColumn("doc", F.substring("doc", 1, 20))
    files = [(wrong, "1"), (texts, "2"), (broken, "3")]
    delivered = [rows.withColumn("file", F.lit(name)) for rows, name in files]
    return docs.parse_weather(delivered[0].unionByName(delivered[1]).unionByName(delivered[2]), "doc", file_col="file")


@query(
    "prediction_records",
    twin("ts, ~predicted_price, mode, ~actual_price, ~error, ~abs_error", "predictions",
         v.PREDICTIONS_SQL),
)
def _prediction_records(spark, sf):
    root = fresh_path(spark, "predictions")
    rows = v.predictions(spark, sf)
    preds.write_predictions(rows.where("mode = 'backtest'"), root, "20240124_000000")
    preds.write_predictions(rows, root, "20240125_000000")
    return preds.latest_predictions(spark, root)


@query(
    "prediction_arrays",
    twin("ts, ~predicted_price, mode, ~actual_price, ~error, ~abs_error", "predictions",
         v.PREDICTIONS_SQL),
)
def _prediction_arrays(spark, sf):
    # Records as JSON arrays, one document a day, read back by the dashboard's reader.
    root = fresh_path(spark, "arrays")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("timestamp")
    record = F.struct(stamp, *preds.FIELDS)
    days = v.predictions(spark, sf).groupBy(F.to_date("ts")).agg(F.collect_list(record).alias("records"))
    days.select(F.to_json("records")).write.text(root)
    return preds.read_predictions(spark, root)


def _landed(spark, sf, root):
    """Events as two overlapping deliveries, the later one landing second."""
    rows = v.events(spark, sf).drop("hour_ts")
    parts = [
        rows.where("ts < '2024-01-21'").withColumn("version", F.lit(1)),
        rows.where("ts >= '2024-01-15'").withColumn("version", F.lit(2)),
    ]
    for i, part in enumerate(parts, 1):
        part.write.parquet(f"{root}/landing/delivery={i}")
    return rows.withColumn("version", F.lit(1)).schema, f"{root}/landing/*"


@query(
    "stream_hourly",
    f"""SELECT user_id % {v.ZONES} AS series_id, event_id, ts, event_type, round(value + 0.000000001::DOUBLE, 6) + 0.0 AS value,
      CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 2 ELSE 1 END AS version,
      strftime(ts, '%Y-%m') AS part_month FROM events""",
)
def _stream_hourly(spark, sf):
    root = fresh_path(spark, "stream")
    schema, landing = _landed(spark, sf, root)
    rows = st.landed_rows(spark, landing, schema).select(
        "series_id", "event_id", "ts", "event_type", "value", "version"
    )
    st.upsert_stream(
        rows, f"{root}/table", f"{root}/progress", ("series_id", "event_id", "ts"), "version"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/table")


@query(
    "stream_dedupe",
    f"""SELECT user_id % {v.ZONES} AS series_id, event_id, ts, round(value + 0.000000001::DOUBLE, 6) + 0.0 AS value FROM events""",
)
def _stream_dedupe(spark, sf):
    # Three deliveries in as many batches, the newest first, with common rows: what
    # comes last is weeks older than what has been seen, and none of it may be lost.
    root = fresh_path(spark, "stream")
    rows = v.events(spark, sf).select("series_id", "event_id", "ts", "value")
    cuts = [("2024-01-15", "9999-01-01"), ("2024-01-05", "2024-01-20"), ("1970-01-01", "2024-01-10")]
    for i, (low, high) in enumerate(cuts, 1):
        part = rows.where(f"ts >= '{low}' AND ts < '{high}'").coalesce(1)
        part.write.parquet(f"{root}/landing/delivery={i}")
        st.upsert_stream(
            st.landed_rows(spark, f"{root}/landing/*", rows.schema, files_per_batch=1),
            f"{root}/out", f"{root}/progress", ("series_id", "event_id", "ts"), "ingest_ts",
        ).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("series_id", "event_id", "ts", "value")


@query(
    "backfill_then_update",
    """SELECT o_custkey AS series_id, o_orderkey, o_orderdate AS ts,
      round((CASE WHEN o_orderdate >= TIMESTAMP '1997-06-10' THEN o_totalprice * 3 ELSE o_totalprice END)
        + 0.000000001::DOUBLE, 6) + 0.0 AS price
    FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'""",
)
def _backfill_then_update(spark, sf):
    # A table stored without versions, an update that begins in its last month, and the
    # same update again with corrected values.
    rows = _orders(spark, sf)
    path = t.table_path(fresh_path(spark, "backfill"), "orders", 1)
    t.write_months(rows.where("ts < '1997-06-15'"), path)
    later = rows.where("ts >= '1997-06-10' AND ts < '1998-01-01'")
    later = later.withColumn("ingest_ts", F.lit("1998-01-02").cast("timestamp"))
    for factor in (2, 3):
        delivery = later.withColumn("price", F.col("price") * factor)
        t.upsert(delivery, path, ("series_id", "o_orderkey", "ts"))
    return spark.read.parquet(path).select("series_id", "o_orderkey", "ts", "price")


@query(
    "month_edge_range",
    """SELECT series_id, ts, price, strftime(ts, '%Y-%m') AS part_month FROM
      (SELECT o_custkey % 5 AS series_id, o_orderdate + INTERVAL 23 HOUR AS ts,
        round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) + 0.000000001::DOUBLE, 6) + 0.0 AS price
      FROM orders GROUP BY ALL)
    WHERE ts >= TIMESTAMP '1997-03-31 23:00:00' AND ts <= TIMESTAMP '1997-04-30 23:00:00'""",
)
def _month_edge_range(spark, sf):
    # Instants of the last hour of a day: the local month is already the next one.
    price = (
        v.table(spark, sf, "orders")
        .groupBy(
            (F.col("o_custkey") % 5).alias("series_id"),
            (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 23 HOURS")).alias("ts"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("price"))
    )
    none = price.where("false")
    load = none.select("series_id", "ts", F.col("price").alias("load_forecast"))
    generation = none.select(
        "series_id", "ts", F.col("price").alias("wind_forecast"), F.col("price").alias("solar_forecast")
    )
    path = t.table_path(fresh_path(spark, "months"), "market", 1)
    t.write_months(market_table(price, load, generation, prefill=False), path)
    rows = t.read_months(spark, path, "1997-03-31 23:00:00", "1997-04-30 23:00:00")
    return rows.select("series_id", "ts", "price", "part_month")


@query(
    "clip_nan",
    """WITH r AS (SELECT o_custkey % 7 AS series_id, o_orderkey, o_orderdate AS ts,
      CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS price FROM orders),
    s AS (SELECT series_id, avg(price) AS a, stddev_samp(price) AS d FROM r GROUP BY 1)
    SELECT series_id, o_orderkey, ts,
      round(CASE WHEN price < a - 1.5 * d THEN a - 1.5 * d WHEN price > a + 1.5 * d THEN a + 1.5 * d ELSE price END
        + 0.000000001::DOUBLE, 6) + 0.0 AS price
    FROM r JOIN s USING (series_id)""",
)
def _clip_nan(spark, sf):
    rows = _orders(spark, sf).withColumn("series_id", F.col("series_id") % 7)
    broken = rows.withColumn(
        "price", F.when(F.col("o_orderkey") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("price"))
    )
    return outlier_clip(broken, ["price"], n_std=1.5)
