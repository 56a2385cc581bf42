"""Axis, repair, lags, cleaning and features on many series, one of them hot.

A series is a user, but every third user's events go to series 0. The number of series
grows with the tables and series 0 holds a third of all events, so these queries see
what the three zones of the other ones can't show: growth of the key and its skew.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.axis import CHECKED_SQL, MARKET, clip_sql
from pricegrid.catalog.features import KEYS, PRICE_DIFFS, PRICE_LAGS, PRICE_ROLLING, tilde
from pricegrid.catalog.registry import query, twin
from pricegrid.operators.fill import null_runs
from pricegrid.operators.grid import axis_partitions, hourly_grid
from pricegrid.operators.lags import lag_features
from pricegrid.operators.quality import missing_stats
from pricegrid.plans import jobs
from pricegrid.plans.cleaning import clean
from pricegrid.plans.features import engineer_on_grid
from pricegrid.schemas import DIFFS, LAGS, MARKET_COLS, MARKET_FEATURES, ROLLING

HOT_EVERY = 3


def market_user(spark, sf_dir):
    user = F.when(F.col("user_id") % HOT_EVERY == 0, F.lit(0)).otherwise(F.col("user_id"))
    rows = v.events(spark, sf_dir).withColumn("series_id", user.cast("long"))
    return v.market_of(rows, [F.col("series_id")])


def market_user_placed(spark, sf_dir):
    """The market per user, and the number of partitions for its axis."""
    rows = market_user(spark, sf_dir)
    return rows, axis_partitions(rows)


USER_SQL = v.sql_market(
    "market_user",
    f"CAST(CASE WHEN user_id % {HOT_EVERY} = 0 THEN 0 ELSE user_id END AS BIGINT) AS series_id,",
)
GRID_SQL = f"{USER_SQL},\n{v.grid_sql('market_user')}"
REPAIRED_SQL = f"{GRID_SQL},\n{v.repair_sql('grid', MARKET_COLS)}"


@query("user_grid", twin(MARKET, "grid", GRID_SQL))
def _user_grid(spark, sf):
    rows, parts = market_user_placed(spark, sf)
    return hourly_grid(rows, parts=parts)


@query("user_gap_repair", twin(MARKET, "repaired", REPAIRED_SQL))
def _user_gap_repair(spark, sf):
    rows, parts = market_user_placed(spark, sf)
    return v.repaired_axis(rows, parts=parts)


@query(
    "user_null_runs",
    f"""WITH {GRID_SQL},
    marked AS (SELECT series_id, ts, price, row_number() OVER (PARTITION BY series_id ORDER BY ts)
      - row_number() OVER (PARTITION BY series_id, price IS NULL ORDER BY ts) AS island FROM grid)
    SELECT series_id, min(ts) AS run_start, max(ts) AS run_end, count(*) AS run_len
    FROM marked WHERE price IS NULL GROUP BY series_id, island""",
)
def _user_null_runs(spark, sf):
    rows, parts = market_user_placed(spark, sf)
    grid = hourly_grid(rows, chunk_hours=v.TEST_CHUNK, parts=parts)
    return null_runs(grid, "price", chunk_hours=v.TEST_CHUNK, parts=parts)


@query(
    "user_missing_stats",
    f"WITH {GRID_SQL}, counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM grid"
        for c in ["series_id", "ts", *MARKET_COLS]
    )
    + ") SELECT * FROM counts WHERE missing_count > 0",
)
def _user_missing_stats(spark, sf):
    rows, parts = market_user_placed(spark, sf)
    return missing_stats(hourly_grid(rows, parts=parts))


def _lags(spark, sf, lags, windows, diffs):
    rows, parts = market_user_placed(spark, sf)
    price = v.repaired_axis(rows, parts=parts).select("series_id", "ts", "price")
    return lag_features(price, lags=lags, windows=windows, diffs=diffs, chunk_hours=v.TEST_CHUNK, parts=parts)


@query(
    "user_lags",
    twin(f"{KEYS}, {tilde([*PRICE_LAGS, *PRICE_DIFFS])}", "lagged", REPAIRED_SQL,
         v.lag_sql("repaired", LAGS, [], DIFFS)),
)
def _user_lags(spark, sf):
    return _lags(spark, sf, LAGS, [], DIFFS).drop("price")


@query(
    "user_rolling",
    twin(f"{KEYS}, {tilde(PRICE_ROLLING)}", "lagged", REPAIRED_SQL,
         v.lag_sql("repaired", [], ROLLING, [])),
)
def _user_rolling(spark, sf):
    return _lags(spark, sf, [], ROLLING, []).drop("price")


@query(
    "user_clean",
    twin(MARKET, "clipped", GRID_SQL, CHECKED_SQL, v.repair_sql("checked", MARKET_COLS),
         clip_sql("repaired", MARKET_COLS[1:], 2.0)),
)
def _user_clean(spark, sf):
    return clean(
        market_user(spark, sf),
        batch_cols=(),
        bounds=(10.0, 120.0),
        n_std=2.0,
        chunk_hours=v.TEST_CHUNK,
    )


FEATURES = ["price", *MARKET_FEATURES, "price_lag_24h", "price_rolling_mean_24h", "price_diff_24h"]


@query(
    "user_features",
    twin(
        f"{KEYS}, hour, day_of_week, is_weekend, {tilde(FEATURES)}",
        f"(SELECT *, {v.CALENDAR_SQL}, {v.MARKET_FEATURES_SQL} FROM lagged)",
        GRID_SQL,
        v.lag_sql("grid", [24], [24], [24]),
        where="load_forecast IS NOT NULL",
    ),
)
def _user_features(spark, sf):
    done = engineer_on_grid(market_user(spark, sf), chunk_hours=v.TEST_CHUNK)
    return done.select("series_id", "ts", "hour", "day_of_week", "is_weekend", *FEATURES)


# Days before and after the run, as stated for the jobs: 180 days of which the last 36
# are test rows, yesterday to tomorrow, a week back to two days on.
WINDOW_DAYS = {"training": (-180, -36), "update": (-1, 1), "scoring": (-7, 2)}
WINDOW_AT = "2024-01-24 00:00:00"


def _counted_sql(name: str, first: int, last: int) -> str:
    inside = (f"ts >= TIMESTAMP '{WINDOW_AT}' + INTERVAL ({first}) DAY"
              f" AND ts <= TIMESTAMP '{WINDOW_AT}' + INTERVAL ({last}) DAY")  # fmt: skip
    return f"count(CASE WHEN {inside} THEN 1 END) AS {name}_rows"


# The market of January is moved back by 0, 20, 70 and 170 days so that every edge is met.
MOVED = (0, 20, 70, 170)


@query(
    "job_windows",
    f"""WITH {USER_SQL},
    moved AS (SELECT series_id, ts - d * INTERVAL 1 DAY AS ts FROM market_user,
      (SELECT unnest({list(MOVED)}) AS d))
    SELECT series_id, {", ".join(_counted_sql(n, *d) for n, d in WINDOW_DAYS.items())} FROM moved GROUP BY ALL""",
)
def _job_windows(spark, sf):
    at = datetime.fromisoformat(WINDOW_AT)
    windows = {"training": jobs.training_window(at), "update": jobs.update_window(at), "scoring": jobs.scoring_window(at)}
    back = F.explode(F.array(*[F.lit(d) for d in MOVED]))
    rows = market_user(spark, sf).select("series_id", "ts", back.alias("d"))
    rows = rows.withColumn("ts", F.col("ts") - F.make_dt_interval(days="d"))

    def inside(window):
        first, last = (F.lit(f"{w:%Y-%m-%d %H:%M:%S}").cast("timestamp") for w in window)
        return F.count(F.when(F.col("ts").between(first, last), 1))

    return rows.groupBy("series_id").agg(*[inside(w).alias(f"{n}_rows") for n, w in windows.items()])
