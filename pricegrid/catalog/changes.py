"""Corrections: features that a change reaches, hourly totals that late rows correct."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.features import KEYS
from pricegrid.catalog.registry import query, twin
from pricegrid.catalog.series import USER_SQL, market_user
from pricegrid.plans import refresh
from pricegrid.plans.features import engineer_on_grid
from pricegrid.schemas import MARKET_FEATURES
from pricegrid.session import fresh_path
from pricegrid.sources import tables as t
from pricegrid.streaming import ingest as st
from pricegrid.streaming import late

# Prices of one hour on three days are corrected, and one hour of another day is stored late.
CORRECTED = "dayofmonth(ts) IN (4, 5, 22) AND hour(ts) = 5 AND price IS NOT NULL"
ADDED = "dayofmonth(ts) = 13 AND hour(ts) = 11"
SHOWN = ["price", *MARKET_FEATURES, "price_lag_1h", "price_lag_24h", "price_lag_168h", "price_rolling_mean_24h",
         "price_rolling_max_168h", "price_diff_24h"]


@query(
    "refreshed_features",
    twin(
        f"{KEYS}, hour, {', '.join('~' + c for c in SHOWN)}, refreshed",
        f"""(SELECT *, {v.CALENDAR_SQL}, {v.MARKET_FEATURES_SQL}, EXISTS (SELECT 1 FROM hits h WHERE h.series_id = lagged.series_id
          AND date_diff('day', CAST(h.ts AS DATE), CAST(lagged.ts AS DATE)) BETWEEN 0 AND 7) AS refreshed FROM lagged)""",
        USER_SQL,
        f"hits AS (SELECT series_id, ts FROM market_user WHERE ({CORRECTED}) OR ({ADDED}))",
        f"corrected AS (SELECT * REPLACE (CASE WHEN {CORRECTED} THEN price + 7 ELSE price END AS price) FROM market_user)",
        v.grid_sql("corrected"),
        v.lag_sql("grid", [1, 24, 168], [24, 168], [24]),
        where="load_forecast IS NOT NULL",
    ),
)
def _refreshed_features(spark, sf):
    root = fresh_path(spark, "refreshed")
    source, features = t.table_path(root, "market", 1), t.table_path(root, "features", 1)
    rows = t.as_double(market_user(spark, sf))
    stored = rows.where(f"NOT ({ADDED})")
    t.write_months(stored, source)
    t.write_months(t.as_double(engineer_on_grid(stored, chunk_hours=v.TEST_CHUNK)), features)
    # The delivery repeats most of what is stored; only what differs is a change.
    corrected = F.when(F.expr(CORRECTED), F.col("price") + 7).otherwise(F.col("price"))
    delivery = rows.withColumn("price", corrected).where("hour(ts) < 12")
    refresh.note_changes(refresh.changed_instants(delivery, t.read_months(spark, source)), features)
    t.upsert(delivery, source)
    refresh.refresh(
        refresh.pending_changes(spark, features),
        lambda months: t.read_months(spark, source, months=months).drop("part_month", "ingest_ts"),
        features,
        F.lit("2024-02-01").cast("timestamp"),
        chunk_hours=v.TEST_CHUNK,
    )
    done = spark.read.parquet(features)
    return done.select("series_id", "ts", F.col("hour").cast("int").alias("hour"), *SHOWN, F.col("ingest_ts").isNotNull().alias("refreshed"))


CUTS = [("2024-01-18", "9999-01-01"), ("2024-01-08", "2024-01-18"), ("1970-01-01", "2024-01-08")]


@query(
    "stream_corrected",
    f"""WITH mark AS (SELECT max(ts) - INTERVAL 1 DAY AS newest FROM events WHERE ts >= TIMESTAMP '{CUTS[0][0]}'),
    e AS (SELECT user_id % {v.ZONES} AS series_id, date_trunc('hour', ts) AS ts, CAST(value AS DECIMAL(18,2)) AS value,
      ts < TIMESTAMP '{CUTS[0][0]}' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= newest AS late FROM events, mark)
    SELECT series_id, ts, count(*) AS row_count, CAST(sum(value) AS DOUBLE) AS total,
      CAST(count(CASE WHEN late THEN 1 END) AS BIGINT) AS late_rows,
      CAST(sum(CASE WHEN late THEN value END) AS DOUBLE) AS late_total FROM e GROUP BY ALL""",
)
def _stream_corrected(spark, sf):
    # Three deliveries, the newest first: all of the older ones is behind the watermark.
    root = fresh_path(spark, "late")
    rows = v.events(spark, sf).select("series_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    for i, (low, high) in enumerate(CUTS, 1):
        rows.where(f"ts >= '{low}' AND ts < '{high}'").coalesce(1).write.parquet(f"{root}/landing/delivery={i}")
        landed = st.landed_rows(spark, f"{root}/landing/*", rows.schema, files_per_batch=1)
        late.corrected_totals(landed, ["series_id"], "value", f"{root}/out", f"{root}/progress").awaitTermination()
    sums = late.totals(spark, f"{root}/out", ["series_id"])
    return sums.withColumns({c: F.col(c).cast("double") for c in ("total", "late_total")})
