"""The scheduled jobs: daily update, training and scoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.errors import error_columns
from pricegrid.operators.market import join_weather
from pricegrid.operators.reports import mode_label
from pricegrid.operators.splits import split_rows
from pricegrid.plans import boosting, models, refresh
from pricegrid.plans.features import engineer_on_grid, engineer_range
from pricegrid.plans.ingest import clean_tables
from pricegrid.schemas import (
    BACKTEST_DAYS,
    FORECAST_DAYS,
    LABEL_COL,
    MONTH,
    SERIES,
    TEST_SHARE,
    TRAINING_DAYS,
    TS,
)
from pricegrid.session import checkpointed, staged_while
from pricegrid.sources import predictions, tables


def training_window(as_of: datetime) -> tuple[datetime, datetime]:
    """Start of the training data and of the test rows for a run at ``as_of``."""
    test_days = int(TRAINING_DAYS * TEST_SHARE)
    return as_of - timedelta(days=TRAINING_DAYS), as_of - timedelta(days=test_days)


def update_window(as_of: datetime) -> tuple[datetime, datetime]:
    """Yesterday to tomorrow."""
    return as_of - timedelta(days=1), as_of + timedelta(days=1)


def scoring_window(as_of: datetime) -> tuple[datetime, datetime]:
    return as_of - timedelta(days=BACKTEST_DAYS), as_of + timedelta(days=FORECAST_DAYS)


def daily_update(
    market: DataFrame, weather: DataFrame, market_path: str, weather_path: str, as_of: str
) -> None:
    """Clean the delivered days and upsert them; safe to repeat."""
    version = F.lit(as_of).cast("timestamp")
    for rows, path in zip(clean_tables(market, weather), (market_path, weather_path)):
        tables.upsert(tables.as_double(rows).withColumn("ingest_ts", version), path)


def daily_refresh(
    market: DataFrame, weather: DataFrame, market_path: str, weather_path: str, features_path: str, as_of: str
) -> list[str]:
    """``daily_update`` that also brings the stored features up to date.

    Only what differs from the stored rows counts as changed. Changes are noted before
    the rows are stored and forgotten once the features are, so a run that follows a dead
    one takes up what that left. One job at a time writes a feature table. Returns the
    months whose rows were read for it.
    """
    spark = market.sparkSession
    version = F.lit(as_of).cast("timestamp")
    for rows, path in zip(clean_tables(market, weather), (market_path, weather_path)):
        with staged_while(tables.with_month(tables.as_double(rows)), "daily") as delivery:
            months = [r[0] for r in delivery.select(MONTH).distinct().collect()]
            stored = tables.stored_table(spark, path)
            if stored is not None:
                stored = stored.where(F.col(MONTH).isin(months))
            refresh.note_changes(refresh.changed_instants(delivery, stored), features_path)
            tables.upsert(delivery.drop(MONTH).withColumn("ingest_ts", version), path)
    changed = refresh.pending_changes(spark, features_path)
    if changed is None:
        return []

    def read(months: list[str]) -> DataFrame:
        market, weather = (tables.read_months(spark, p, months=months) for p in (market_path, weather_path))
        return join_weather(market.drop("ingest_ts", MONTH), weather.drop("ingest_ts", MONTH), (SERIES, TS), "inner")

    read_for = refresh.refresh(changed, read, features_path, version)
    refresh.forget_changes(spark, features_path)
    return read_for


def train_job(
    history: DataFrame,
    test_start: str,
    model_root: str,
    runs_path: str,
    name: str,
    version: int,
    family: str = "boosted_trees",
    series_cols: Sequence[str] = (SERIES,),
    **params,
) -> PipelineModel:
    """Features, split, fit, metrics per split, saved model and registry row.

    The labelled rows are checkpointed: learning passes over them once per
    round and must not derive the features anew after losing an executor.
    """
    rows = split_rows(
        engineer_on_grid(history, series_cols=series_cols),
        F.lit(test_start).cast("timestamp"),
        series_cols=series_cols,
    )
    rows = checkpointed(rows)
    model = models.train(rows, family=family, **params)
    scored = models.score(rows, model, ["split", LABEL_COL])
    scored = scored.withColumnRenamed(LABEL_COL, "actual_price").withColumns(error_columns())
    models.save_model(model, model_root, name, version)
    by_split = models.metrics_by_split(scored)
    count = len(models.model_inputs(model))
    models.register(models.run_rows(by_split, name, count, version), runs_path)
    return model


def boost_job(
    history: DataFrame,
    test_start: str,
    model_root: str,
    runs_path: str,
    name: str,
    version: int,
    settings: boosting.Settings = boosting.LEVEL_WISE,
    series_cols: Sequence[str] = (SERIES,),
) -> DataFrame:
    """``train_job`` with the regularised trees of ``boosting``; returns the stored nodes.

    Training ends once the validation error has not improved for ``settings.patience``
    rounds, and the registered errors are those of the best round, scored from the table.
    """
    rows = split_rows(
        engineer_on_grid(history, series_cols=series_cols),
        F.lit(test_start).cast("timestamp"),
        series_cols=series_cols,
    )
    rows = checkpointed(rows)
    model = boosting.fit(rows, settings=settings)
    boosting.save_nodes(boosting.model_nodes(rows.sparkSession, model), model_root, name, version)
    nodes = boosting.load_nodes(rows.sparkSession, model_root, name, version)
    scored = boosting.score_nodes(rows, nodes, ["split", LABEL_COL])
    scored = scored.withColumnRenamed(LABEL_COL, "actual_price").withColumns(error_columns())
    by_split = models.metrics_by_split(scored)
    models.register(models.run_rows(by_split, name, len(model.features), version), runs_path)
    return nodes


def score_job(
    history: DataFrame,
    model: PipelineModel | DataFrame,
    as_of: str,
    predictions_root: str,
    run_ts: str,
    keys: Sequence[str] = (SERIES, TS),
) -> DataFrame:
    """Score the days before and after ``as_of`` and write the records.

    ``model`` is a fitted pipeline, or the nodes of boosted trees. History reaches
    back far enough for every lag of the first scored row.
    """
    start, end = scoring_window(datetime.fromisoformat(as_of))
    featured = engineer_range(history, str(start), str(end), on_grid=True)
    labelled = mode_label(featured, F.lit(as_of).cast("timestamp"), BACKTEST_DAYS, FORECAST_DAYS)
    if isinstance(model, DataFrame):
        scored = models.score_modes_with(labelled, lambda df, keep: boosting.score_nodes(df, model, keep), keys)
    else:
        scored = models.score_modes(labelled, model, keys)
    predictions.write_predictions(scored, predictions_root, run_ts)
    return scored
