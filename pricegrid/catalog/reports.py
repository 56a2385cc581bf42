"""Predictions: modes, errors, summaries, rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.registry import query, rounded, twin
from pricegrid.operators import reports as r
from pricegrid.operators.lags import lag_by_time, lag_features
from pricegrid.operators.splits import split_rows
from pricegrid.plans.models import best_run, run_rows

PRED = v.PREDICTIONS_SQL
AS_OF_SQL = f"TIMESTAMP '{v.AS_OF}'"
METRICS = "row_count, scored_rows, ~mae, ~rmse, ~r2, ~mape"


def metrics_sql(source: str, keys: str) -> str:
    return f"""(SELECT {keys} count(*) AS row_count, count(actual_price) AS scored_rows,
      avg(abs(actual_price - predicted_price)) AS mae,
      sqrt(avg(power(actual_price - predicted_price, 2))) AS rmse,
      1 - sum(power(actual_price - predicted_price, 2)) / regr_syy(actual_price, actual_price) AS r2,
      avg(abs(actual_price - predicted_price) / greatest(actual_price, 1e-8)) * 100 AS mape
      FROM {source} GROUP BY ALL)"""


@query("mode_label", twin("ts, ~predicted_price, ~actual_price, mode", "predictions", PRED))
def _mode_label(spark, sf):
    return v.predictions(spark, sf).select("ts", "predicted_price", "actual_price", "mode")


@query(
    "mode_window",
    twin(
        "ts, mode",
        "predictions",
        PRED,
        where=f"ts >= {AS_OF_SQL} - INTERVAL 7 DAY AND ts <= {AS_OF_SQL} + INTERVAL 2 DAY",
    ),
)
def _mode_window(spark, sf):
    rows = v.predictions(spark, sf).select("ts")
    return r.mode_label(rows, v.as_of(), backtest_days=7, forecast_days=2)


@query(
    "mode_masks",
    twin(
        "ts, ~backtest_price, ~forecast_price",
        """(SELECT ts, CASE WHEN mode = 'backtest' THEN predicted_price END AS backtest_price,
          CASE WHEN mode = 'forecast' THEN predicted_price END AS forecast_price FROM predictions)""",
        PRED,
    ),
)
def _mode_masks(spark, sf):
    return r.mode_masks(v.predictions(spark, sf)).select("ts", "backtest_price", "forecast_price")


@query(
    "display_subset",
    twin(
        "ts, mode, ~predicted_price",
        "predictions",
        PRED,
        where="mode = 'forecast' OR NOT EXISTS (SELECT 1 FROM predictions WHERE mode = 'forecast')",
    ),
)
def _display_subset(spark, sf):
    return r.display_subset(v.predictions(spark, sf)).select("ts", "mode", "predicted_price")


@query(
    "detail_table",
    twin(
        "timestamp, ~predicted_price, mode, ~actual_price",
        """(SELECT strftime(ts, '%Y-%m-%d %H:%M') AS timestamp, CAST(round(CAST(CAST(predicted_price AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) AS predicted_price, mode, actual_price
          FROM predictions)""",
        PRED,
    ),
)
def _detail_table(spark, sf):
    return r.detail_table(v.predictions(spark, sf))


@query("error_metrics", twin(METRICS, metrics_sql("predictions", ""), PRED))
def _error_metrics(spark, sf):
    return r.metrics(v.predictions(spark, sf))


LABELLED_SQL = f"""{PRED},
    numbered AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY ts) - 1 AS i,
      count(*) OVER (PARTITION BY mode) AS n FROM predictions),
    labelled AS (SELECT *, CASE WHEN mode = 'forecast' THEN 'test' WHEN i < floor(n * 0.85::DOUBLE) THEN 'train'
      ELSE 'val' END AS split FROM numbered)"""


def _labelled(spark, sf):
    rows = v.predictions(spark, sf).withColumn("series_id", F.lit("all"))
    return split_rows(rows, v.as_of(), chunk_hours=v.TEST_CHUNK)


@query("metrics_by_split", twin(f"split, {METRICS}", metrics_sql("labelled", "split,"), LABELLED_SQL))
def _metrics_by_split(spark, sf):
    return r.metrics(_labelled(spark, sf), ["split"])


BASELINE_SQL = f"""{v.ZONE_REPAIRED_SQL},
    persistence AS (SELECT a.series_id, a.ts, a.price AS actual_price, b.price AS predicted_price
      FROM repaired a JOIN repaired b ON a.series_id = b.series_id AND b.ts = a.ts - INTERVAL 24 HOUR)"""


@query(
    "persistence_baseline",
    twin(f"series_id, {METRICS}", metrics_sql("persistence", "series_id,"), BASELINE_SQL),
)
def _persistence_baseline(spark, sf):
    price = v.zone_repaired(spark, sf).select("series_id", "ts", "price")
    lagged = lag_by_time(price, "price", 24, name="predicted_price")
    scored = lagged.withColumnRenamed("price", "actual_price")
    return r.metrics(scored.where("predicted_price is not null"), ["series_id"])


@query(
    "score_summary",
    twin(
        "mode, row_count, first_ts, last_ts, ~avg_price, ~min_price, ~max_price, ~mae",
        """(SELECT mode, count(*) AS row_count, min(ts) AS first_ts, max(ts) AS last_ts,
          avg(predicted_price) AS avg_price, min(predicted_price) AS min_price,
          max(predicted_price) AS max_price, avg(abs_error) AS mae FROM predictions GROUP BY ALL)""",
        PRED,
    ),
)
def _score_summary(spark, sf):
    return r.score_summary(v.predictions(spark, sf), ["mode"])


@query(
    "value_ranges",
    twin(
        "column_name, ~min_value, ~max_value",
        """(SELECT 'wind_forecast' AS column_name, min(wind_forecast) AS min_value,
          max(wind_forecast) AS max_value FROM market_zone
          UNION ALL SELECT 'solar_forecast', min(solar_forecast), max(solar_forecast) FROM market_zone)""",
        v.ZONE_SQL,
    ),
)
def _value_ranges(spark, sf):
    return r.value_ranges(v.market_zone(spark, sf), ["wind_forecast", "solar_forecast"])


@query(
    "dashboard_metrics",
    twin(
        "~avg_price, ~min_price, ~max_price, ~mae, ~min_delta, ~max_delta",
        """(SELECT avg(predicted_price) AS avg_price, min(predicted_price) AS min_price,
          max(predicted_price) AS max_price, avg(abs_error) AS mae,
          min(predicted_price) - avg(predicted_price) AS min_delta,
          max(predicted_price) - avg(predicted_price) AS max_delta FROM predictions)""",
        PRED,
    ),
)
def _dashboard_metrics(spark, sf):
    return r.dashboard_metrics(v.predictions(spark, sf))


@query(
    "mae_alert",
    twin(
        "day, ~mae",
        """(SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, avg(abs_error) AS mae FROM predictions
          GROUP BY ALL HAVING avg(abs_error) > 8.0)""",
        PRED,
    ),
)
def _mae_alert(spark, sf):
    rows = v.predictions(spark, sf).withColumn("day", F.to_date("ts").cast("string"))
    return r.mae_alert(rows, ["day"])


@query(
    "hourly_profile",
    twin(
        "hour, ~avg_price",
        "(SELECT hour(ts) AS hour, avg(predicted_price) AS avg_price FROM predictions GROUP BY ALL)",
        PRED,
    ),
)
def _hourly_profile(spark, sf):
    return r.hourly_profile(v.predictions(spark, sf))


@query(
    "price_histogram",
    twin(
        "bin, ~bin_low, ~bin_high, row_count",
        """(SELECT bin, lo + bin * w AS bin_low, lo + (bin + 1) * w AS bin_high, row_count FROM (
          SELECT CAST(least(floor((predicted_price - lo) / w), 19) AS INT) AS bin, lo, w,
            count(*) AS row_count
          FROM predictions, (SELECT min(predicted_price) AS lo,
            (max(predicted_price) - min(predicted_price)) / 20 AS w FROM predictions) GROUP BY ALL))""",
        PRED,
    ),
)
def _price_histogram(spark, sf):
    return r.price_histogram(v.predictions(spark, sf))


@query(
    "heatmap_pivot",
    "WITH "
    + PRED
    + " SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, "
    + ", ".join(
        rounded(f"max(CASE WHEN hour(ts) = {h} THEN predicted_price END)", f"h{h:02d}")
        for h in range(24)
    )
    + " FROM predictions GROUP BY ALL",
)
def _heatmap_pivot(spark, sf):
    out = r.heatmap(v.predictions(spark, sf))
    return out.withColumn("date", F.col("date").cast("string"))


@query(
    "duplicate_cells",
    f"""SELECT user_id % {v.ZONES} AS series_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, hour(ts) AS hour,
      count(*) AS row_count FROM events GROUP BY ALL HAVING count(*) > 1""",
)
def _duplicate_cells(spark, sf):
    out = r.duplicate_cells(v.events(spark, sf), by=["series_id"])
    return out.withColumn("date", F.col("date").cast("string"))


@query(
    "cheapest_hours",
    f"""WITH {PRED} SELECT ts, round(predicted_price + 0.000000001::DOUBLE, 6) + 0.0 AS predicted_price
      FROM predictions ORDER BY predictions.predicted_price, ts LIMIT 4""",
)
def _cheapest_hours(spark, sf):
    return r.cheapest_hours(v.predictions(spark, sf)).select("ts", "predicted_price")


@query(
    "cheapest_hours_window",
    f"""WITH {PRED}, found AS (SELECT count(*) AS n FROM predictions
        WHERE ts BETWEEN {AS_OF_SQL} AND {AS_OF_SQL} + INTERVAL 24 HOUR)
      SELECT ts, round(predicted_price + 0.000000001::DOUBLE, 6) + 0.0 AS predicted_price FROM predictions
      WHERE ts BETWEEN {AS_OF_SQL} AND {AS_OF_SQL} + INTERVAL 24 HOUR OR (SELECT n FROM found) < 4
      ORDER BY predictions.predicted_price, ts LIMIT 4""",
)
def _cheapest_hours_window(spark, sf):
    return r.cheapest_hours_window(v.predictions(spark, sf), v.as_of()).select(
        "ts", "predicted_price"
    )


@query(
    "cheapest_hours_per_day",
    twin(
        "series_id, ts, ~price, price_rank",
        """(SELECT series_id, ts, price, row_number() OVER (PARTITION BY series_id, CAST(ts AS DATE)
          ORDER BY price, ts) AS price_rank FROM repaired)""",
        v.ZONE_REPAIRED_SQL,
        where="price_rank <= 4",
    ),
)
def _cheapest_hours_per_day(spark, sf):
    rows = v.zone_repaired(spark, sf).select("series_id", "ts", "price")
    return r.cheapest_hours_per_day(rows, price_col="price", by=["series_id"]).drop("date")


RUNS = [1, 24, 48, 168]


def _runs_sql() -> str:
    parts = []
    for version, k in enumerate(RUNS, 1):
        parts.append(
            f"""SELECT {version} AS version, split, count(*) AS row_count,
        avg(abs(price - p)) AS mae, sqrt(avg(power(price - p, 2))) AS rmse,
        1 - sum(power(price - p, 2)) / regr_syy(price, price) AS r2
      FROM (SELECT a.series_id, a.ts, a.price, b.price AS p, split FROM repaired a
        JOIN repaired b ON a.series_id = b.series_id AND b.ts = a.ts - INTERVAL {k} HOUR
        JOIN labelled l ON l.series_id = a.series_id AND l.ts = a.ts) GROUP BY split"""
        )
    wide = ", ".join(
        f"max(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}"
        for s in ("train", "val", "test")
        for m in ("mae", "rmse", "r2")
    )
    return f"""part AS (SELECT series_id, ts, ts >= {AS_OF_SQL} AS is_test FROM grid),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id, is_test ORDER BY ts) - 1 AS i,
      count(*) OVER (PARTITION BY series_id, is_test) AS n FROM part),
    labelled AS (SELECT series_id, ts, CASE WHEN is_test THEN 'test' WHEN i < floor(n * 0.85::DOUBLE) THEN 'train'
      ELSE 'val' END AS split FROM numbered),
    scored AS ({" UNION ALL ".join(parts)}),
    runs AS (SELECT 'persistence' AS model, version, {wide},
      max(CASE WHEN split = 'train' THEN row_count END) AS training_samples FROM scored GROUP BY version)"""


RUN_COLS = (
    "model, version, "
    + ", ".join(f"~{s}_{m}" for s in ("train", "val", "test") for m in ("mae", "rmse", "r2"))
    + ", training_samples, 1 AS feature_count"
)


@query(
    "model_runs_best",
    twin(
        RUN_COLS,
        "(SELECT * FROM runs ORDER BY test_mae, version DESC LIMIT 1)",
        v.ZONE_REPAIRED_SQL,
        _runs_sql(),
    ),
)
def _model_runs_best(spark, sf):
    price = v.zone_repaired(spark, sf).select("series_id", "ts", "price")
    lagged = lag_features(price, lags=RUNS, windows=[], diffs=[], chunk_hours=v.TEST_CHUNK)
    rows = split_rows(lagged, v.as_of(), chunk_hours=v.TEST_CHUNK)
    attempts = [
        F.struct(F.lit(i).alias("version"), F.col(f"price_lag_{k}h").alias("predicted_price"))
        for i, k in enumerate(RUNS, 1)
    ]
    scored = rows.select(
        "split", F.col("price").alias("actual_price"), F.inline(F.array(*attempts))
    ).where("predicted_price is not null")
    runs = run_rows(r.metrics(scored, ["version", "split"]), "persistence", 1)
    return best_run(runs).drop("trained_at")
