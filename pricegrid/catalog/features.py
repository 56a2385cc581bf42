"""Joins, weather, features and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.registry import query, rounded, twin
from pricegrid.functions.features import interaction_features, market_features, time_features
from pricegrid.operators import market as mk
from pricegrid.operators.lags import lag_by_time, lag_features
from pricegrid.operators.splits import hash_split, split_rows
from pricegrid.operators.weather import normalise_weights, weighted_mean
from pricegrid.plans.features import engineer, engineer_on_grid, engineer_range
from pricegrid.plans.models import align_features, training_matrix
from pricegrid.schemas import (
    DIFFS,
    INTERACTION_FEATURES,
    LAGS,
    MARKET_COLS,
    MARKET_FEATURES,
    ROLLING,
    WEATHER_COLS,
)

KEYS = "series_id, ts"
MARKET = "~price, ~load_forecast, ~wind_forecast, ~solar_forecast"
WEATHER = "~temperature_avg, ~wind_speed_10m_avg, ~wind_speed_80m_avg, ~irradiance_avg"


def tilde(cols) -> str:
    return ", ".join(f"~{c}" for c in cols)


PRICE_LAGS = [f"price_lag_{k}h" for k in LAGS]
PRICE_ROLLING = [f"price_rolling_{s}_{n}h" for n in ROLLING for s in ("mean", "std", "min", "max")]
PRICE_DIFFS = [f"price_diff_{k}h" for k in DIFFS]


@query(
    "gen_type_sum",
    f"""SELECT user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS ts,
      round(coalesce(sum(CASE WHEN event_type IN ('view', 'signup') THEN value END), 0), 6) + 0.0 AS wind_forecast,
      round(coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0), 6) + 0.0 AS solar_forecast
    FROM events WHERE event_type IN ('view', 'signup', 'click') GROUP BY ALL""",
)
def _gen_type_sum(spark, sf):
    kind = (
        F.when(F.col("event_type") == "click", "B16")
        .when(F.col("event_type") == "view", "B18")
        .when(F.col("event_type") == "signup", "B19")
        .otherwise("B01")
    )
    points = v.events(spark, sf).select(
        "series_id", F.col("hour_ts").alias("ts"), kind.alias("psr_type"),
        F.col("value").alias("quantity"),
    )
    return mk.generation_by_type(points)


@query(
    "row_mean",
    twin(
        "series_id, ts, ~load_forecast",
        """(SELECT series_id, ts, (coalesce(price, 0) + load_forecast + wind_forecast + solar_forecast)
          / (3 + CAST(price IS NOT NULL AS INT)) AS load_forecast FROM market_zone)""",
        v.ZONE_SQL,
    ),
)
def _row_mean(spark, sf):
    return mk.wide_load(v.market_zone(spark, sf))


@query(
    "wide_sum",
    twin(
        "series_id, ts, ~wind_forecast, ~solar_forecast",
        """(SELECT series_id, ts, price + wind_forecast AS wind_forecast, solar_forecast FROM market_zone)""",
        v.ZONE_SQL,
    ),
)
def _wide_sum(spark, sf):
    wide = v.market_zone(spark, sf).withColumnsRenamed(
        {"price": "Wind Offshore", "wind_forecast": "Wind Onshore", "solar_forecast": "Solar"}
    )
    return mk.wide_generation(wide.drop("load_forecast"))


@query(
    "split_columns",
    twin(
        "part, series_id, ts, ~v1, ~v2, ~v3, ~v4",
        """(SELECT 'market' AS part, series_id, ts, price AS v1, load_forecast AS v2, wind_forecast AS v3,
          solar_forecast AS v4 FROM merged
          UNION ALL SELECT 'weather', series_id, ts, temperature_avg, wind_speed_10m_avg,
          wind_speed_80m_avg, irradiance_avg FROM merged)""",
        v.MERGED_SQL,
    ),
)
def _split_columns(spark, sf):
    left, right = mk.split_columns(v.market_weather(spark, sf))

    def long(df, part, cols):
        names = [F.col(c).alias(f"v{i}") for i, c in enumerate(cols, 1)]
        return df.select(F.lit(part).alias("part"), "series_id", "ts", *names)

    return long(left, "market", MARKET_COLS).unionByName(long(right, "weather", WEATHER_COLS))


@query(
    "market_join",
    twin(
        f"{KEYS}, {MARKET}",
        """(SELECT p.series_id, p.ts, p.price, l.load_forecast, g.wind_forecast, g.solar_forecast
          FROM p LEFT JOIN l ON p.series_id = l.series_id AND p.ts = l.ts
          LEFT JOIN g ON p.series_id = g.series_id AND p.ts = g.ts)""",
        f"e AS (SELECT *, user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS h FROM events)",
        "p AS (SELECT series_id, h AS ts, avg(value) AS price FROM e WHERE event_type = 'purchase' GROUP BY ALL)",
        "l AS (SELECT series_id, h AS ts, sum(value) AS load_forecast FROM e WHERE event_type = 'error' GROUP BY ALL)",
        """g AS (SELECT series_id, h AS ts, coalesce(sum(CASE WHEN event_type = 'view' THEN value END), 0) AS wind_forecast,
          coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0) AS solar_forecast
          FROM e WHERE event_type IN ('view', 'click') GROUP BY ALL)""",
    ),
)
def _market_join(spark, sf):
    rows = v.events(spark, sf)
    keys = ["series_id", F.col("hour_ts").alias("ts")]
    price = rows.where("event_type = 'purchase'").groupBy(*keys).agg(F.avg("value").alias("price"))
    load = (
        rows.where("event_type = 'error'").groupBy(*keys).agg(F.sum("value").alias("load_forecast"))
    )
    generation = mk.generation_by_type(
        rows.select(*keys, F.col("event_type").alias("psr_type"), F.col("value").alias("quantity")),
        wind_types=["view"],
        solar_types=["click"],
    )
    return mk.join_market(price, load, generation)


@query("market_weather_join", twin(f"{KEYS}, {MARKET}, {WEATHER}", "merged", v.MERGED_SQL))
def _market_weather_join(spark, sf):
    return v.market_weather(spark, sf)


@query(
    "weight_normalise",
    f"""SELECT series_id, event_type AS location, round(count(*) / sum(count(*)) OVER
      (PARTITION BY series_id), 6) + 0.0 AS weight FROM (SELECT *, user_id % {v.ZONES} AS series_id FROM events)
      GROUP BY series_id, event_type""",
)
def _weight_normalise(spark, sf):
    raw = (
        v.events(spark, sf)
        .groupBy("series_id", F.col("event_type").alias("location"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    return normalise_weights(raw)


@query("weather_weighted", twin(f"{KEYS}, {WEATHER}", "weather_zone", v.WEATHER_SQL))
def _weather_weighted(spark, sf):
    return v.weather_zone(spark, sf)


@query(
    "weather_renormalised",
    twin(
        f"{KEYS}, ~temperature_avg",
        """(SELECT series_id, ts, sum(temperature_2m * w) / sum(w) AS temperature_avg FROM (
          SELECT *, CAST(CASE WHEN location = 'view' THEN 0.4 ELSE 0.2 END AS DOUBLE) AS w
          FROM weather_readings) GROUP BY ALL)""",
        v.READINGS_SQL,
    ),
)
def _weather_renormalised(spark, sf):
    return weighted_mean(
        v.weather_readings(spark, sf),
        v.location_weights(spark),
        values={"temperature_2m": "temperature_avg"},
        renormalise=True,
    )


ORDER_TS_SQL = "stamped AS (SELECT o_orderkey, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS ts FROM orders)"


def _stamped_orders(spark, sf):
    ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int")
    )
    return v.table(spark, sf, "orders").select("o_orderkey", ts.alias("ts"))


FLAGS = (
    "hour, day_of_week, month, day_of_year, week_of_year, is_weekend, is_holiday, "
    "is_peak_morning, is_peak_evening"
)


@query(
    "time_features",
    twin(f"o_orderkey, {FLAGS}", f"(SELECT o_orderkey, {v.CALENDAR_SQL} FROM stamped)", ORDER_TS_SQL),
)
def _time_features(spark, sf):
    out = time_features(_stamped_orders(spark, sf))
    return out.drop("ts", "hour_sin", "hour_cos", "month_sin", "month_cos")


@query(
    "local_time_features",
    twin(
        f"o_orderkey, {FLAGS}",
        f"(SELECT o_orderkey, {v.CALENDAR_SQL} FROM (SELECT o_orderkey, "
        "timezone('Europe/Stockholm', timezone('UTC', ts)) AS ts FROM stamped))",
        ORDER_TS_SQL,
    ),
)
def _local_time_features(spark, sf):
    out = time_features(_stamped_orders(spark, sf), zone="Europe/Stockholm")
    return out.drop("ts", "hour_sin", "hour_cos", "month_sin", "month_cos")


@query(
    "cyclic_features",
    twin(
        "o_orderkey, ~hour_sin, ~hour_cos, ~month_sin, ~month_cos",
        f"(SELECT o_orderkey, {v.CALENDAR_SQL} FROM stamped)",
        ORDER_TS_SQL,
    ),
)
def _cyclic_features(spark, sf):
    return time_features(_stamped_orders(spark, sf)).select(
        "o_orderkey", "hour_sin", "hour_cos", "month_sin", "month_cos"
    )


@query(
    "market_features",
    twin(
        f"{KEYS}, {tilde(MARKET_FEATURES)}",
        f"(SELECT series_id, ts, {v.MARKET_FEATURES_SQL} FROM market_zone)",
        v.ZONE_SQL,
    ),
)
def _market_features(spark, sf):
    return market_features(v.market_zone(spark, sf)).select("series_id", "ts", *MARKET_FEATURES)


@query(
    "interaction_features",
    twin(
        f"{KEYS}, {tilde(INTERACTION_FEATURES)}",
        f"(SELECT series_id, ts, {v.INTERACTION_SQL} FROM merged)",
        v.MERGED_SQL,
    ),
)
def _interaction_features(spark, sf):
    rows = v.market_weather(spark, sf).withColumn("hour", F.hour("ts"))
    return interaction_features(rows).select("series_id", "ts", *INTERACTION_FEATURES)


def _zone_lags(spark, sf, lags, windows, diffs):
    price = v.zone_repaired(spark, sf).select("series_id", "ts", "price")
    return lag_features(
        price, lags=lags, windows=windows, diffs=diffs, chunk_hours=v.TEST_CHUNK
    )


@query(
    "price_lags",
    twin(f"{KEYS}, {tilde(PRICE_LAGS)}", "lagged", v.ZONE_REPAIRED_SQL,
         v.lag_sql("repaired", LAGS, [], [])),
)
def _price_lags(spark, sf):
    return _zone_lags(spark, sf, LAGS, [], []).drop("price")


HOLE = ("2024-01-10 00:00:00", "2024-01-12 12:00:00")
GAPPED_SQL = f"""{v.ZONE_SQL}, gapped AS (SELECT series_id, ts, price FROM market_zone
    WHERE ts < TIMESTAMP '{HOLE[0]}' OR ts >= TIMESTAMP '{HOLE[1]}'),
lagged AS (SELECT g.*, a.price AS price_lag_1h, b.price AS price_lag_24h, g.price - b.price AS price_diff_24h
  FROM gapped g LEFT JOIN gapped a ON a.series_id = g.series_id AND a.ts = g.ts - INTERVAL 1 HOUR
  LEFT JOIN gapped b ON b.series_id = g.series_id AND b.ts = g.ts - INTERVAL 24 HOUR)"""


@query(
    "price_lags_gapped",
    twin(f"{KEYS}, ~price, ~price_lag_1h, ~price_lag_24h, ~price_diff_24h", "lagged", GAPPED_SQL),
)
def _price_lags_gapped(spark, sf):
    rows = v.market_zone(spark, sf).select("series_id", "ts", "price")
    rows = rows.where(f"ts < '{HOLE[0]}' OR ts >= '{HOLE[1]}'")
    done = engineer_on_grid(rows, chunk_hours=v.TEST_CHUNK)
    return done.select("series_id", "ts", "price", "price_lag_1h", "price_lag_24h", "price_diff_24h")


@query(
    "price_rolling",
    twin(f"{KEYS}, {tilde(PRICE_ROLLING)}", "lagged", v.ZONE_REPAIRED_SQL,
         v.lag_sql("repaired", [], ROLLING, [])),
)
def _price_rolling(spark, sf):
    return _zone_lags(spark, sf, [], ROLLING, []).drop("price")


@query(
    "price_diffs",
    twin(f"{KEYS}, {tilde(PRICE_DIFFS)}", "lagged", v.ZONE_REPAIRED_SQL,
         v.lag_sql("repaired", [], [], DIFFS)),
)
def _price_diffs(spark, sf):
    return _zone_lags(spark, sf, [], [], DIFFS).drop("price")


@query(
    "price_lag_by_time",
    twin(
        f"{KEYS}, ~price_lag_24h",
        """(SELECT a.series_id, a.ts, b.price AS price_lag_24h FROM market_zone a LEFT JOIN market_zone b
          ON a.series_id = b.series_id AND b.ts = a.ts - INTERVAL 24 HOUR)""",
        v.ZONE_SQL,
    ),
)
def _price_lag_by_time(spark, sf):
    rows = v.market_zone(spark, sf).select("series_id", "ts", "price")
    return lag_by_time(rows, "price", 24).drop("price")


DAILY = ([1, 7, 28], [7, 28], [1, 7])
DAILY_COLS = (
    [f"price_lag_{k}d" for k in DAILY[0]]
    + [f"price_rolling_{s}_{n}d" for n in DAILY[1] for s in ("mean", "std", "min", "max")]
    + [f"price_diff_{k}d" for k in DAILY[2]]
)


@query(
    "revenue_rolling",
    twin(f"{KEYS}, {tilde(DAILY_COLS)}", "lagged", v.REVENUE_SQL,
         v.lag_sql("daily_revenue", *DAILY, suffix="d"), digits=2),
    digits=2,
)
def _revenue_rolling(spark, sf):
    lags, windows, diffs = DAILY
    return lag_features(
        v.daily_revenue(spark, sf),
        lags=lags,
        windows=windows,
        diffs=diffs,
        suffix="d",
        regular=False,
    ).drop("price")


FULL_COLS = (
    f"{KEYS}, {MARKET}, {WEATHER}, {FLAGS}, ~hour_sin, ~hour_cos, ~month_sin, ~month_cos, "
    + tilde([*MARKET_FEATURES, *PRICE_LAGS, *PRICE_ROLLING, *PRICE_DIFFS, *INTERACTION_FEATURES])
)
FULL_SQL = f"""{v.MERGED_REPAIRED_SQL},
{v.lag_sql("repaired", LAGS, ROLLING, DIFFS)},
full_features AS (SELECT *, {v.CALENDAR_SQL}, {v.MARKET_FEATURES_SQL}, {v.INTERACTION_SQL} FROM lagged)"""


def full_features_of(spark, sf):
    return engineer(v.merged_repaired(spark, sf), chunk_hours=v.TEST_CHUNK)


@query("full_features", twin(FULL_COLS, "full_features", FULL_SQL))
def _full_features(spark, sf):
    return full_features_of(spark, sf)


@query(
    "feature_range",
    twin(
        FULL_COLS,
        "full_features",
        FULL_SQL,
        where="ts >= TIMESTAMP '2024-01-17 00:00:00' AND ts <= TIMESTAMP '2024-01-26 00:00:00'",
    ),
)
def _feature_range(spark, sf):
    return engineer_range(
        v.merged_repaired(spark, sf),
        "2024-01-17 00:00:00",
        "2024-01-26 00:00:00",
        chunk_hours=v.TEST_CHUNK,
    )


MATRIX = [
    *MARKET_COLS[1:],
    *WEATHER_COLS,
    *"hour day_of_week month day_of_year week_of_year is_weekend is_holiday".split(),
    *"hour_sin hour_cos month_sin month_cos is_peak_morning is_peak_evening".split(),
    *MARKET_FEATURES,
    *PRICE_LAGS,
    *PRICE_ROLLING,
    *INTERACTION_FEATURES,
]


def zeroed(cols) -> str:
    return ", ".join(rounded(f"coalesce(CAST({c} AS DOUBLE), 0)", c) for c in cols)


@query(
    "training_matrix",
    f"WITH {FULL_SQL} SELECT series_id, ts, {zeroed(MATRIX)}, {rounded('price', 'price')} "
    "FROM full_features WHERE price IS NOT NULL",
)
def _training_matrix(spark, sf):
    return training_matrix(full_features_of(spark, sf))


ALIGNED = ["hour", "price_lag_168h", "snow_depth", "residual_load"]


@query(
    "align_features",
    f"WITH {FULL_SQL} SELECT series_id, ts, {zeroed(ALIGNED[:2])}, 0.0::DOUBLE AS snow_depth, "
    f"{zeroed(ALIGNED[3:])} FROM full_features",
)
def _align_features(spark, sf):
    return align_features(full_features_of(spark, sf), ALIGNED, ["series_id", "ts"])


SPLIT_SQL = f"""{v.ZONE_GRID_SQL},
    part AS (SELECT series_id, ts, ts >= TIMESTAMP '{v.AS_OF}' AS is_test FROM grid),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id, is_test ORDER BY ts) - 1 AS i,
      count(*) OVER (PARTITION BY series_id, is_test) AS n FROM part),
    labelled AS (SELECT series_id, ts, CASE WHEN is_test THEN 'test' WHEN i < floor(n * 0.85::DOUBLE) THEN 'train'
      ELSE 'val' END AS split FROM numbered)"""


@query("split_rows", f"WITH {SPLIT_SQL} SELECT series_id, ts, split FROM labelled")
def _split_rows(spark, sf):
    rows = v.zone_grid(spark, sf).select("series_id", "ts")
    return split_rows(rows, v.as_of(), chunk_hours=v.TEST_CHUNK)


HASH_SQL = """(SELECT *, CASE WHEN CAST('0x' || substr(md5(series_id || '|' || CAST(ts AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 2000
  THEN 'test' ELSE 'train' END AS split FROM market_zone)"""


@query("hash_split", twin(f"{KEYS}, {MARKET}, split", HASH_SQL, v.ZONE_SQL))
def _hash_split(spark, sf):
    return hash_split(v.market_zone(spark, sf), ["series_id", "ts"])
