"""Time axis, time zones, deduplication, quality and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.registry import query, twin
from pricegrid.functions.timezones import local_to_utc, position_time, utc_to_local
from pricegrid.operators import quality
from pricegrid.operators.chunks import row_index
from pricegrid.operators.dedupe import keep_first
from pricegrid.operators.fill import ffill_bfill, null_runs
from pricegrid.operators.grid import hourly_grid
from pricegrid.operators.reports import gap_alert
from pricegrid.operators.splits import month_slices
from pricegrid.plans.cleaning import clean
from pricegrid.schemas import MARKET_COLS
from pricegrid.sources.tables import with_month

MARKET = "series_id, ts, ~price, ~load_forecast, ~wind_forecast, ~solar_forecast"


@query("hourly_grid", twin(MARKET, "grid", v.ZONE_GRID_SQL))
def _hourly_grid(spark, sf):
    return hourly_grid(v.market_zone(spark, sf))


@query(
    "hourly_mean",
    twin(
        MARKET,
        "grid",
        f"""quarter AS (SELECT user_id % {v.ZONES} AS series_id, time_bucket(INTERVAL 15 MINUTE, ts) AS qts,
          avg(value) AS price, sum(value) AS load_forecast, min(value) AS wind_forecast, max(value) AS solar_forecast
          FROM events GROUP BY ALL)""",
        """hourly AS (SELECT series_id, date_trunc('hour', qts) AS ts, avg(price) AS price,
          avg(load_forecast) AS load_forecast, avg(wind_forecast) AS wind_forecast,
          avg(solar_forecast) AS solar_forecast FROM quarter GROUP BY ALL)""",
        v.grid_sql("hourly"),
    ),
)
def _hourly_mean(spark, sf):
    quarter = F.timestamp_seconds(
        F.unix_seconds("ts") - F.pmod(F.unix_seconds("ts"), F.lit(900))
    )
    fine = (
        v.events(spark, sf)
        .groupBy("series_id", quarter.alias("ts"))
        .agg(
            F.avg("value").alias("price"),
            F.sum("value").alias("load_forecast"),
            F.min("value").alias("wind_forecast"),
            F.max("value").alias("solar_forecast"),
        )
    )
    return hourly_grid(fine, resample="mean")


@query(
    "dedupe_first",
    """SELECT user_id, hour_ts, event_id, event_type, round(value + 0.000000001::DOUBLE, 6) + 0.0 AS value FROM (
      SELECT *, date_trunc('hour', ts) AS hour_ts,
        row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS rn
      FROM events) WHERE rn = 1""",
)
def _dedupe_first(spark, sf):
    rows = v.events(spark, sf).select("user_id", "hour_ts", "event_id", "event_type", "value")
    return keep_first(rows, ["user_id", "hour_ts"], ["event_id"])


@query(
    "position_time",
    """SELECT conv_id, turn, TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL 1 HOUR
      + turn * INTERVAL 15 MINUTE AS ts FROM conversations""",
)
def _position_time(spark, sf):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(
        hours=F.col("conv_id").cast("int")
    )
    return v.table(spark, sf, "conversations").select(
        "conv_id", "turn", position_time(start, F.col("turn") + 1, F.lit(15)).alias("ts")
    )


@query(
    "local_to_utc",
    """SELECT o_custkey, ts, o_orderkey FROM (
      SELECT o_custkey, o_orderkey, timezone('UTC', timezone('Europe/Stockholm', o_orderdate)) AS ts,
        row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn
      FROM orders) WHERE rn = 1""",
)
def _local_to_utc(spark, sf):
    rows = v.table(spark, sf, "orders").select(
        "o_custkey", local_to_utc("o_orderdate").alias("ts"), "o_orderkey"
    )
    return keep_first(rows, ["o_custkey", "ts"], ["o_orderkey"])


@query(
    "utc_to_local",
    """SELECT o_orderkey, timezone('Europe/Stockholm', timezone('UTC', o_orderdate
      + (o_orderkey % 24) * INTERVAL 1 HOUR)) AS local_ts FROM orders""",
)
def _utc_to_local(spark, sf):
    instant = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int")
    )
    return v.table(spark, sf, "orders").select(
        "o_orderkey", utc_to_local(instant).alias("local_ts")
    )


@query(
    "row_positions",
    """SELECT o_custkey, o_orderkey,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS row_index,
      count(*) OVER (PARTITION BY o_custkey) AS row_total FROM orders""",
)
def _row_positions(spark, sf):
    instant = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        secs=F.col("o_orderkey") / 1e6
    )
    rows = v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", instant.alias("ts"))
    return row_index(rows, ["o_custkey"], total_col="row_total").drop("ts")


@query(
    "month_slices",
    """WITH r AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
      FROM orders GROUP BY ALL),
    k AS (SELECT *, unnest(generate_series(0, datediff('month', s, e))) AS k FROM r),
    m AS (SELECT *, CAST(date_trunc('month', s) + to_months(CAST(k AS INT)) AS DATE) AS m0 FROM k),
    d AS (SELECT *, min(CASE WHEN k = 0 THEN 31 ELSE day(last_day(m0)) END)
      OVER (PARTITION BY o_custkey ORDER BY k) AS shortest FROM m),
    b AS (SELECT o_custkey, k, e, m0 + CAST(least(day(s), shortest) - 1 AS INT) AS b FROM d),
    n AS (SELECT *, lead(b) OVER (PARTITION BY o_custkey ORDER BY k) AS nb FROM b)
    SELECT o_custkey, CAST(k AS INT) AS slice_no, CAST(b AS VARCHAR) AS slice_start,
      CAST(least(coalesce(nb, e), e) AS VARCHAR) AS slice_end FROM n WHERE b < e""",
)
def _month_slices(spark, sf):
    ranges = (
        v.table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").cast("date").alias("start_date"),
            F.max("o_orderdate").cast("date").alias("end_date"),
        )
    )
    return month_slices(ranges).select(
        "o_custkey",
        "slice_no",
        F.col("slice_start").cast("string").alias("slice_start"),
        F.col("slice_end").cast("string").alias("slice_end"),
    )


@query(
    "coerce_numeric",
    """SELECT event_id, round(TRY_CAST(props->>'$.k' AS DOUBLE), 6) + 0.0 AS k,
      TRY_CAST(props AS DOUBLE) AS props, TRY_CAST(event_type AS DOUBLE) AS event_type FROM events""",
)
def _coerce_numeric(spark, sf):
    rows = v.table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "props", "event_type"
    )
    return quality.coerce_numeric(rows, ["k", "props", "event_type"])


@query(
    "missing_stats",
    "WITH "
    + v.ZONE_GRID_SQL
    + """, counts AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM grid"
        for c in ["series_id", "ts", *MARKET_COLS]
    )
    + ") SELECT * FROM counts WHERE missing_count > 0",
)
def _missing_stats(spark, sf):
    return quality.missing_stats(v.zone_grid(spark, sf))


@query(
    "quality_counts",
    f"""WITH {v.ZONE_GRID_SQL},
    twice AS (SELECT * FROM grid UNION ALL SELECT * FROM market_zone WHERE price < 20)
    SELECT series_id, count(*) AS row_count, count(*) - count(DISTINCT ts) AS duplicate_count,
      CAST(sum(CASE WHEN price IS NULL OR load_forecast IS NULL OR wind_forecast IS NULL
        OR solar_forecast IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS incomplete_rows,
      CAST(sum(CASE WHEN price < 20 OR price > 80 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_prices
    FROM twice GROUP BY ALL""",
)
def _quality_counts(spark, sf):
    again = v.market_zone(spark, sf).where("price < 20")
    rows = v.zone_grid(spark, sf).unionByName(again)
    return quality.quality_counts(rows, value_cols=MARKET_COLS, bounds=(20.0, 80.0))


@query(
    "valid_range",
    twin(
        "series_id, ts, ~price",
        "(SELECT series_id, ts, CASE WHEN price BETWEEN 30 AND 70 THEN price END AS price FROM market_zone)",
        v.ZONE_SQL,
    ),
)
def _valid_range(spark, sf):
    rows = v.market_zone(spark, sf).select("series_id", "ts", "price")
    return quality.valid_range(rows, bounds=(30.0, 70.0))


def _filled_sql() -> str:
    cols = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN "
        f"UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY series_id "
        f"ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in MARKET_COLS
    )
    return f"(SELECT series_id, ts, {cols} FROM grid)"


@query("ffill_bfill", twin(MARKET, _filled_sql(), v.ZONE_GRID_SQL))
def _ffill_bfill(spark, sf):
    return ffill_bfill(v.zone_grid(spark, sf), chunk_hours=v.TEST_CHUNK)


RUNS_SQL = f"""{v.ZONE_GRID_SQL},
    marked AS (SELECT series_id, ts, price, row_number() OVER (PARTITION BY series_id ORDER BY ts)
      - row_number() OVER (PARTITION BY series_id, price IS NULL ORDER BY ts) AS island FROM grid),
    runs AS (SELECT series_id, min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_len
      FROM marked WHERE price IS NULL GROUP BY series_id, island)"""


@query("null_runs", f"WITH {RUNS_SQL} SELECT series_id, run_start, run_end, run_len FROM runs")
def _null_runs(spark, sf):
    return null_runs(v.zone_grid(spark, sf), "price", chunk_hours=v.TEST_CHUNK)


@query(
    "gap_alert",
    f"WITH {RUNS_SQL} SELECT series_id, run_start, run_end, run_len FROM runs WHERE run_len > 2",
)
def _gap_alert(spark, sf):
    runs = null_runs(v.zone_grid(spark, sf), "price", chunk_hours=v.TEST_CHUNK)
    return gap_alert(runs, 2)


@query(
    "gap_repair",
    twin(MARKET, "repaired", v.ZONE_GRID_SQL, v.repair_sql("grid", MARKET_COLS, 1)),
)
def _gap_repair(spark, sf):
    return v.repaired_axis(v.market_zone(spark, sf), max_gap=1)


def clip_sql(source: str, cols: list[str], n_std: float, name: str = "clipped") -> str:
    def bound(c: str, sign: str) -> str:
        over = "OVER (PARTITION BY series_id)"
        return f"(avg({c}) {over} {sign} {n_std} * stddev_samp({c}) {over})"

    fixed = ", ".join(
        f"CASE WHEN {c} < {bound(c, '-')} THEN {bound(c, '-')} "
        f"WHEN {c} > {bound(c, '+')} THEN {bound(c, '+')} ELSE {c} END AS {c}"
        for c in cols
    )
    return f"{name} AS (SELECT * REPLACE ({fixed}) FROM {source})"


@query(
    "outlier_clip",
    twin(MARKET, "clipped", v.ZONE_SQL, clip_sql("market_zone", MARKET_COLS[1:], 2.0)),
)
def _outlier_clip(spark, sf):
    return quality.outlier_clip(
        v.market_zone(spark, sf), MARKET_COLS[1:], n_std=2.0, chunk_hours=v.TEST_CHUNK
    )


@query(
    "outlier_counts",
    f"""WITH {v.ZONE_SQL},
    s AS (SELECT series_id, avg(load_forecast) AS m, stddev_samp(load_forecast) AS d FROM market_zone GROUP BY ALL)
    SELECT z.series_id, count(CASE WHEN abs(load_forecast - m) > 2.0 * d THEN 1 END) AS load_forecast_outliers
    FROM market_zone z JOIN s ON z.series_id = s.series_id GROUP BY ALL""",
)
def _outlier_counts(spark, sf):
    return quality.outlier_counts(v.market_zone(spark, sf), ["load_forecast"], n_std=2.0)


CHECKED_SQL = (
    "checked AS (SELECT * REPLACE (CASE WHEN price BETWEEN 10 AND 120 THEN price END AS price) FROM grid)"
)
CLEAN_SQL = [
    v.ZONE_GRID_SQL,
    CHECKED_SQL,
    v.repair_sql("checked", MARKET_COLS),
    clip_sql("repaired", MARKET_COLS[1:], 2.0),
]


@query("clean_series", twin(MARKET, "clipped", *CLEAN_SQL))
def _clean_series(spark, sf):
    rows = with_month(v.market_zone(spark, sf))
    cleaned = clean(rows, bounds=(10.0, 120.0), n_std=2.0)
    return cleaned.drop("part_month")


@query("clean_long_series", twin(MARKET, "clipped", *CLEAN_SQL))
def _clean_long_series(spark, sf):
    return clean(
        v.market_zone(spark, sf),
        batch_cols=(),
        bounds=(10.0, 120.0),
        n_std=2.0,
        chunk_hours=v.TEST_CHUNK,
    )
