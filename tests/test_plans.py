"""Physical plans: what must and must not be in them."""

import re

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from pricegrid.catalog import registry
from pricegrid.catalog import views as v
from pricegrid.operators.lags import lag_features
from pricegrid.operators.weather import weighted_mean
from pricegrid.schemas import MARKET_COLS, WEATHER_COLS

QUERIES = registry.QUERIES
# Summaries over everything; the rows are reduced to one per task beforehand.
GLOBAL = {
    "missing_stats", "error_metrics", "dashboard_metrics", "value_ranges",
    "price_histogram", "display_subset", "cheapest_hours", "cheapest_hours_window",
    "model_runs_best", "feature_importance",
    "user_missing_stats",  # the summary of missing_stats on more series
    # A model's nodes become one nested array, and sums per feature one total; the
    # number of trees and their leaves bounds both, no data row is gathered.
    "boosted_scores", "boosted_importance",
}
WRITES = {
    "month_roundtrip", "month_range", "upsert_latest", "fg_range_join", "engineered_table",
    "prediction_records", "stream_hourly", "stream_dedupe", "backfill_then_update", "month_edge_range", "train_gbt", "score_modes",
    "feature_importance", "linear_baseline", "refreshed_features", "stream_corrected",
}
DATA = {*MARKET_COLS, *WEATHER_COLS}


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan(name, spark, small):
    text = plan(QUERIES[name](spark, small))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    if name not in GLOBAL:
        assert "SinglePartition" not in text


@pytest.mark.parametrize(
    "name", ["gap_repair", "ffill_bfill", "clean_long_series", "price_rolling", "full_features"]
)
def test_long_windows_are_chunked(name, spark, small):
    """Windows over a series alone see chunk summaries only, never data columns."""
    text = plan(QUERIES[name](spark, small))
    found = re.findall(r"\((\w+)#\d+L?[^()]*\) windowspecdefinition\((.*?), specifiedwindow", text)
    assert found
    for column, spec in found:
        if "__chunk" not in spec:
            assert column not in DATA, (column, spec)


def test_repair_after_grid_needs_one_exchange_of_the_data(spark, small):
    df = QUERIES["gap_repair"](spark, small)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    # the data once executed and once reused, and the few edge rows of the chunks
    assert final.count("REPARTITION_BY_COL") == 3
    assert "ReusedExchange" in final


def test_top_rows_per_day_are_cut_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(QUERIES["cheapest_hours_per_day"](spark, small))


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(QUERIES["price_lag_by_time"](spark, small))
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", text):
        assert "props" not in schema and "event_id" not in schema


def test_small_weights_are_broadcast_and_large_ones_shuffled(spark, small):
    readings = v.weather_readings(spark, small)
    weights = v.location_weights(spark)
    assert "BroadcastHashJoin" in plan(weighted_mean(readings, weights))
    want = sorted(map(str, weighted_mean(readings, weights).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = weighted_mean(readings, weights)
        assert "BroadcastHashJoin" not in plan(other)
        assert len(other.collect()) == len(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rolling_counts_each_frame_once(spark, small):
    price = v.market_zone(spark, small).select("series_id", "ts", "price")
    text = plan(lag_features(price))
    assert len(re.findall(r"count\(price#\d+\) windowspec", text.split("Initial Plan")[0])) <= 2


def test_range_filter_reaches_the_scan(spark, small, tmp_path):
    from pricegrid.sources import tables as t

    path = str(tmp_path / "m_v1")
    t.write_months(v.market_zone(spark, small), path)
    text = plan(t.read_months(spark, path, "2024-01-05 00:00:00", "2024-01-06 00:00:00"))
    assert re.search(r"PartitionFilters: \[.*part_month.*>= 2024-01", text)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)


def test_long_cleaning_exchanges_the_data_twice(spark, small):
    """Once for all columns, once for the statistics; fills reuse both."""
    df = QUERIES["clean_long_series"](spark, small)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+L, __chunk#\d+L, \d+\), REP", final)) <= 6
