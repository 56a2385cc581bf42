"""Stand-in market views on the test tables, in Spark and in SQL.

Money has two decimals in the tables, so sums are taken as decimals: they are
exact and independent of row order in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.functions.errors import error_columns
from pricegrid.operators.fill import gap_repair
from pricegrid.operators.grid import hourly_grid
from pricegrid.operators.lags import lag_features
from pricegrid.operators.market import join_weather
from pricegrid.operators.reports import mode_label
from pricegrid.operators.weather import weighted_mean
from pricegrid.schemas import MARKET_COLS, WEATHER_COLS
from pricegrid.sources.documents import literal_table

ZONES = 3
AS_OF = "2024-01-24 00:00:00"
# Small enough that the test series span several chunks.
TEST_CHUNK = 256
LOCATION_TYPES = [("view", 0.4), ("click", 0.2), ("signup", 0.2), ("error", 0.2)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").withColumns(
        {"ts": ts, "hour_ts": F.date_trunc("hour", ts), "series_id": F.col("user_id") % ZONES}
    )


def _money(*types: str) -> Column:
    return F.sum(
        F.when(F.col("event_type").isin(list(types)), F.col("value").cast("decimal(18,2)"))
    ).cast("double")


def market_of(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """Hourly market columns of events, per key."""
    purchases = F.count(F.when(F.col("event_type") == "purchase", 1))
    return (
        rows
        .groupBy(*keys, F.col("hour_ts").alias("ts"))
        .agg(
            F.try_divide(_money("purchase"), purchases).alias("price"),
            F.coalesce(_money("purchase", "error"), F.lit(0.0)).alias("load_forecast"),
            F.coalesce(_money("view"), F.lit(0.0)).alias("wind_forecast"),
            F.coalesce(_money("click"), F.lit(0.0)).alias("solar_forecast"),
        )
    )


def market_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_of(events(spark, sf_dir), []).select(
        F.lit("all").alias("series_id"), "ts", *MARKET_COLS
    )


def market_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market_of(events(spark, sf_dir), [F.col("series_id")])


def zone_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_grid(market_zone(spark, sf_dir), chunk_hours=TEST_CHUNK)


def repaired_axis(rows: DataFrame, max_gap: int = 6, parts: int | None = None) -> DataFrame:
    grid = hourly_grid(rows, chunk_hours=TEST_CHUNK, keep_chunk=True, parts=parts)
    return gap_repair(grid, max_gap_hours=max_gap, chunk_hours=TEST_CHUNK, parts=parts)


def zone_repaired(spark: SparkSession, sf_dir: str, max_gap: int = 6) -> DataFrame:
    return repaired_axis(market_zone(spark, sf_dir), max_gap)


def location_weights(spark: SparkSession) -> DataFrame:
    return literal_table(spark, LOCATION_TYPES, ["location", "weight"])


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    rows = events(spark, sf_dir).where(F.col("event_type") != "purchase")
    n = F.count(F.lit(1))
    money = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return rows.groupBy(
        "series_id", F.col("hour_ts").alias("ts"), F.col("event_type").alias("location")
    ).agg(
        (money / n).alias("temperature_2m"),
        (F.sum(k).cast("double") / n).alias("wind_speed_10m"),
        F.max(k).cast("double").alias("wind_speed_80m"),
        money.alias("irradiance"),
    )


def weather_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_mean(weather_readings(spark, sf_dir), location_weights(spark))


def market_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_weather(market_zone(spark, sf_dir), weather_zone(spark, sf_dir))


def merged_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market with weather on the hourly axis, all columns repaired."""
    return repaired_axis(market_weather(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persistence forecast of the whole market: the price a day earlier."""
    price = repaired_axis(market_hourly(spark, sf_dir).select("series_id", "ts", "price"))
    lagged = lag_features(price, "price", lags=[24], windows=[], diffs=[], chunk_hours=TEST_CHUNK)
    known = lagged.where("price_lag_24h is not null").select(
        "ts",
        F.col("price_lag_24h").alias("predicted_price"),
        F.col("price").alias("actual_price"),
    )
    return mode_label(known, as_of()).withColumns(error_columns())


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per nation and order day."""
    money = F.col("l_extendedprice").cast("decimal(12,2)") * (
        F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    )
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(money).alias("amount"))
    )
    return (
        per_order.join(
            table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
            "o_orderkey",
        )
        .join(
            table(spark, sf_dir, "customer").select(
                F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("series_id")
            ),
            "o_custkey",
        )
        .groupBy(
            "series_id",
            F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts"),
        )
        .agg(F.sum("amount").cast("double").alias("price"))
    )


# ---------------------------------------------------------------- SQL twins


def _sql_money(types: str) -> str:
    return (
        f"CAST(sum(CASE WHEN event_type IN ({types}) THEN CAST(value AS DECIMAL(18,2)) END)"
        " AS DOUBLE)"
    )


def sql_market(name: str, keys: str) -> str:
    return f"""{name} AS (
  SELECT {keys} date_trunc('hour', ts) AS ts,
    {_sql_money("'purchase'")} / nullif(count(CASE WHEN event_type = 'purchase' THEN 1 END), 0) AS price,
    coalesce({_sql_money("'purchase', 'error'")}, 0) AS load_forecast,
    coalesce({_sql_money("'view'")}, 0) AS wind_forecast,
    coalesce({_sql_money("'click'")}, 0) AS solar_forecast
  FROM events GROUP BY ALL)"""


MARKET_SQL = sql_market("market_hourly", "'all' AS series_id,")
ZONE_SQL = sql_market("market_zone", f"user_id % {ZONES} AS series_id,")

READINGS_SQL = f"""weather_readings AS (
  SELECT user_id % {ZONES} AS series_id, date_trunc('hour', ts) AS ts, event_type AS location,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS temperature_2m,
    CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS DOUBLE) / count(*) AS wind_speed_10m,
    CAST(max(CAST(props->>'$.k' AS BIGINT)) AS DOUBLE) AS wind_speed_80m,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS irradiance
  FROM events WHERE event_type <> 'purchase' GROUP BY ALL)"""

WEATHER_SQL = f"""{READINGS_SQL},
weather_zone AS (
  SELECT series_id, ts, sum(temperature_2m * w) AS temperature_avg,
    sum(wind_speed_10m * w) AS wind_speed_10m_avg,
    sum(wind_speed_80m * w) AS wind_speed_80m_avg, sum(irradiance * w) AS irradiance_avg
  FROM (SELECT *, CAST(CASE WHEN location = 'view' THEN 0.4 ELSE 0.2 END AS DOUBLE) AS w
        FROM weather_readings)
  GROUP BY ALL)"""

MERGED_SQL = f"""{ZONE_SQL},
{WEATHER_SQL},
merged AS (SELECT m.*, w.* EXCLUDE (series_id, ts) FROM market_zone m
  LEFT JOIN weather_zone w ON m.series_id = w.series_id AND m.ts = w.ts)"""


def grid_sql(source: str, name: str = "grid") -> str:
    return f"""axis AS (
  SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
  FROM (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM {source} GROUP BY ALL)),
{name} AS (SELECT a.series_id, a.ts, s.* EXCLUDE (series_id, ts) FROM axis a
  LEFT JOIN {source} s ON a.series_id = s.series_id AND a.ts = s.ts)"""


def repair_sql(source: str, cols: list[str], max_gap: int = 6, name: str = "repaired") -> str:
    near = []
    fixed = []
    for c in cols:
        back = "OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        ahead = "OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        at = f"CASE WHEN {c} IS NOT NULL THEN epoch_ms(ts) / 3600000 END"
        near += [
            f"last_value({c} IGNORE NULLS) {back} AS pv_{c}",
            f"first_value({c} IGNORE NULLS) {ahead} AS nv_{c}",
            f"last_value({at} IGNORE NULLS) {back} AS pi_{c}",
            f"first_value({at} IGNORE NULLS) {ahead} AS ni_{c}",
        ]
        fixed.append(
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN nv_{c} "
            f"WHEN nv_{c} IS NULL THEN pv_{c} WHEN ni_{c} - pi_{c} - 1 <= {max_gap} "
            f"THEN pv_{c} + (nv_{c} - pv_{c}) * (epoch_ms(ts) / 3600000 - pi_{c}) / (ni_{c} - pi_{c}) "
            f"ELSE pv_{c} END AS {c}"
        )
    return f"""near_{name} AS (SELECT *, {", ".join(near)} FROM {source}),
{name} AS (SELECT * EXCLUDE ({", ".join(c for c in cols)},
    {", ".join(f"pv_{c}, nv_{c}, pi_{c}, ni_{c}" for c in cols)}), {", ".join(fixed)} FROM near_{name})"""


ZONE_GRID_SQL = f"{ZONE_SQL},\n{grid_sql('market_zone')}"
ZONE_REPAIRED_SQL = f"{ZONE_GRID_SQL},\n{repair_sql('grid', MARKET_COLS)}"
MERGED_REPAIRED_SQL = (
    f"{MERGED_SQL},\n{grid_sql('merged')},\n{repair_sql('grid', [*MARKET_COLS, *WEATHER_COLS])}"
)
PREDICTIONS_SQL = f"""{MARKET_SQL},
{grid_sql("market_hourly")},
{repair_sql("grid", ["price"])},
lagged AS (SELECT ts, lag(price, 24) OVER (PARTITION BY series_id ORDER BY ts) AS predicted_price,
    price AS actual_price FROM repaired),
predictions AS (SELECT *, CASE WHEN ts < TIMESTAMP '{AS_OF}' THEN 'backtest' ELSE 'forecast' END AS mode,
    actual_price - predicted_price AS error, abs(actual_price - predicted_price) AS abs_error
  FROM lagged WHERE predicted_price IS NOT NULL)"""

REVENUE_SQL = """daily_revenue AS (
  SELECT c_nationkey AS series_id, date_trunc('day', o_orderdate) AS ts,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY ALL)"""


def lag_sql(
    source: str,
    lags: list[int],
    windows: list[int],
    diffs: list[int],
    suffix: str = "h",
    name: str = "lagged",
) -> str:
    """Lags, guarded frames and differences of ``price``, written out plainly."""
    w = "PARTITION BY series_id ORDER BY ts"
    cols = [f"lag(price, {k}) OVER ({w}) AS price_lag_{k}{suffix}" for k in lags]
    for n in windows:
        frame = f"OVER ({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            cols.append(
                f"CASE WHEN count(price) {frame} = {n} THEN {fn}(price) {frame} END"
                f" AS price_rolling_{stat}_{n}{suffix}"
            )
    cols += [f"price - lag(price, {k}) OVER ({w}) AS price_diff_{k}{suffix}" for k in diffs]
    return f"{name} AS (SELECT *, {', '.join(cols)} FROM {source})"


CALENDAR_SQL = """hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, month(ts) AS month,
    dayofyear(ts) AS day_of_year, weekofyear(ts) AS week_of_year,
    CAST(isodow(ts) >= 6 AS INT) AS is_weekend,
    CAST(strftime(ts, '%m-%d') IN ('01-01', '01-06', '05-01', '06-06', '12-24', '12-25', '12-26', '12-31') AS INT) AS is_holiday,
    sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
    sin(2 * pi() * month(ts) / 12) AS month_sin, cos(2 * pi() * month(ts) / 12) AS month_cos,
    CAST(hour(ts) BETWEEN 7 AND 9 AS INT) AS is_peak_morning,
    CAST(hour(ts) BETWEEN 17 AND 20 AS INT) AS is_peak_evening"""

MARKET_FEATURES_SQL = """load_forecast - wind_forecast - solar_forecast AS residual_load,
    CASE WHEN load_forecast = 0 THEN CASE WHEN wind_forecast + solar_forecast > 0 THEN 1.0
           WHEN wind_forecast + solar_forecast < 0 THEN 0.0 END
         WHEN (wind_forecast + solar_forecast) / load_forecast > 1 THEN 1.0
         WHEN (wind_forecast + solar_forecast) / load_forecast < 0 THEN 0.0
         ELSE (wind_forecast + solar_forecast) / load_forecast END AS renewable_ratio,
    CASE WHEN load_forecast - wind_forecast - solar_forecast < 0
         THEN -(load_forecast - wind_forecast - solar_forecast) ELSE 0.0 END AS renewable_surplus,
    (load_forecast - wind_forecast - solar_forecast) / nullif(load_forecast, 0) AS load_stress"""

INTERACTION_SQL = """temperature_avg * load_forecast AS temp_load_interaction,
    CASE WHEN wind_speed_80m_avg > 0 THEN wind_forecast / (wind_speed_80m_avg * wind_speed_80m_avg * wind_speed_80m_avg)
         ELSE 0.0 END AS wind_efficiency,
    hour(ts) * load_forecast AS hour_load_interaction"""
