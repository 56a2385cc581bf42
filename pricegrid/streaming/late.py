"""Hourly totals that late rows correct: nothing behind the watermark is lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricegrid.schemas import MONTH, TS
from pricegrid.sources import tables, versions

BATCH_ID = "batch"


def corrected_totals(
    rows: DataFrame,
    by: Sequence[str],
    value_col: str,
    path: str,
    checkpoint: str,
    ts_col: str = TS,
    delay: str = "1 day",
) -> StreamingQuery:
    """Sum up everything that has landed per hour, then stop; run it on a schedule.

    An hour counts as emitted once the newest instant of earlier batches, less ``delay``,
    has passed its end. Rows of an emitted hour are late: they are kept whole in a side
    table (:func:`late_rows`), and their sums correct the hour (:func:`totals`).

    Every batch adds its own sums under its number, so a batch that is repeated after a
    failure replaces what it wrote and counts once. No state is held between batches but
    one instant. Rows without an instant belong to no hour and are late rows. ``path``
    and ``checkpoint`` belong together: with a new checkpoint take a new path.
    """
    versions.create(rows.sparkSession, _parts(path))

    def apply(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            _add(batch, number, by, value_col, path, ts_col, delay)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _add(batch: DataFrame, number: int, by: Sequence[str], value_col: str, path: str, ts_col: str, delay: str) -> None:
    spark = batch.sparkSession
    instants = batch.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    seen = None
    if number > 0:
        seen = spark.read.parquet(_mark(path, number - 1)).first()["newest_us"]
    newest = instants.agg(F.max(F.unix_micros(ts_col)).alias("newest_us"))
    emitted = F.timestamp_micros(F.lit(seen).cast("long")) - F.expr(f"INTERVAL {delay}")
    hour = F.date_trunc("hour", F.col(ts_col))
    over = F.coalesce(hour + F.expr("INTERVAL 1 HOUR") <= emitted, F.lit(False))
    marked = instants.withColumn("__late", over | F.col(ts_col).isNull())
    marked.where("__late").drop("__late").write.mode("overwrite").parquet(f"{path}/late/{BATCH_ID}={number}")
    sums = (
        marked.where(F.col(ts_col).isNotNull())
        .groupBy(*by, hour.alias(ts_col))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(value_col).alias("total"),
            F.count(F.when(F.col("__late"), 1)).alias("late_rows"),
            F.sum(F.when(F.col("__late"), F.col(value_col))).alias("late_total"),
        )
        .withColumn(BATCH_ID, F.lit(number).cast("long"))
    )
    tables.upsert(sums, _parts(path), [*by, ts_col, BATCH_ID], BATCH_ID, ts_col)
    mark = newest.select(F.greatest("newest_us", F.lit(seen).cast("long")).alias("newest_us"))
    mark.write.mode("overwrite").parquet(_mark(path, number))


def totals(spark: SparkSession, path: str, by: Sequence[str], start=None, end=None, ts_col: str = TS) -> DataFrame:
    """Count and sum per hour as of now, with what came after the hour was emitted."""
    parts = tables.read_months(spark, _parts(path), start, end, ts_col=ts_col).drop(MONTH, BATCH_ID)
    sums = [F.sum(c).alias(c) for c in ("row_count", "total", "late_rows", "late_total")]
    return parts.groupBy(*by, ts_col).agg(*sums)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their hour was emitted, whole, with the number of their batch."""
    return spark.read.parquet(f"{path}/late")


def _parts(path: str) -> str:
    return f"{path.rstrip('/')}/parts"


def _mark(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/marks/{BATCH_ID}={number}"
