"""The number of partitions follows the rows of an axis, so that a task's memory does not grow."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricegrid.operators import chunks
from pricegrid.operators.grid import axis_partitions
from pricegrid.plans.cleaning import clean
from pricegrid.plans.features import engineer_on_grid
from pricegrid.plans.refresh import reached_days, reached_features

HOURS, SERIES = 200, 60


@pytest.fixture
def sparse(spark, monkeypatch):
    """Sixty series of two known hours each, 200 hours apart, and tasks of 500 rows."""
    monkeypatch.setattr(chunks, "TASK_ROWS", 500)
    first = pd.Timestamp("2024-01-01 00:30:00")
    rows = [
        (s, first + pd.Timedelta(hours=h), 50.0 + s, 10.0 + h)
        for s in range(SERIES)
        for h in (0, HOURS - 1)
    ]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["series_id", "ts", "price", "load_forecast"]))


def most_rows(df):
    """Rows of the fullest partition, and all rows."""
    sizes = df.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    return sizes.max(), sizes.sum()


def test_axis_partitions_count_hours_not_rows(sparse):
    assert axis_partitions(sparse, ["series_id"]) == SERIES * HOURS // 500
    assert axis_partitions(sparse.where("false"), ["series_id"]) == 4
    repeated = sparse.limit(1).crossJoin(sparse.sparkSession.range(6000)).drop("id")
    assert axis_partitions(repeated, ["series_id"]) == 12
    unknown = sparse.select(F.lit(None).cast("long").alias("series_id"), F.lit(None).cast("timestamp").alias("ts"))
    assert axis_partitions(unknown, ["series_id"]) == 4


def test_cleaning_deals_out_expanded_hours(sparse):
    most, rows = most_rows(clean(sparse, batch_cols=(), chunk_hours=50))
    assert rows == SERIES * HOURS
    assert most <= 1500


def test_features_deal_out_the_hours_of_the_axis(sparse, monkeypatch):
    """The rows that a task of the lags holds, holes and copies at chunk edges included."""
    seen = []
    monkeypatch.setattr("pricegrid.operators.lags.home_rows", lambda df: seen.append(df) or chunks.home_rows(df))
    done = engineer_on_grid(sparse, chunk_hours=168)
    most, rows = most_rows(seen[0])
    assert rows >= SERIES * HOURS
    assert most <= 3000
    assert done.count() == 2 * SERIES


def test_refreshed_days_are_dealt_out(sparse, monkeypatch):
    seen = []
    monkeypatch.setattr("pricegrid.operators.lags.home_rows", lambda df: seen.append(df) or chunks.home_rows(df))
    days = reached_days(sparse.select("series_id", "ts"))
    done = reached_features(sparse, days, chunk_hours=168)
    assert seen[0].rdd.getNumPartitions() == 24 * days.count() // 500 + 1
    assert done.count() == 2 * SERIES
