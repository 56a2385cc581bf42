"""Incremental ingest of newly landed rows into a feature table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricegrid.schemas import SERIES, TS
from pricegrid.sources.tables import upsert


def landed_rows(
    spark: SparkSession, path: str, schema, files_per_batch: int | None = None, glob: str | None = None
) -> DataFrame:
    """Stream of Parquet files as they land."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def upsert_stream(
    rows: DataFrame,
    table_path: str,
    checkpoint: str,
    key_cols: Sequence[str] = (SERIES, TS),
    version_col: str = "ingest_ts",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Upsert everything that has landed, then stop; run it on a schedule.

    A batch that is repeated after a failure gives the same table, because the
    upsert keeps the latest version per key.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        batch.persist()
        try:
            ready = prepare(batch) if prepare else batch
            upsert(ready, table_path, key_cols, version_col)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(
    rows: DataFrame, keys: Sequence[str], ts_col: str = TS, delay: str = "3 days"
) -> DataFrame:
    """Drop re-deliveries of a key that arrive within ``delay``; late rows go too.

    The state holds the keys of that span only, so a row older than the newest instant
    less ``delay`` can't be told from a repeat and is dropped even if it is the first of
    its key. Where no first delivery may be lost, use ``upsert_stream`` on the key: it
    compares with the table and takes rows of any age.
    """
    instants = rows.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return instants.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_totals(
    rows: DataFrame, by: Sequence[str], value_col: str, ts_col: str = TS, delay: str = "1 day"
) -> DataFrame:
    """Count and sum per hour; an hour is emitted once, when the watermark passes it.

    Rows that come later than ``delay`` are not counted. Hours that may still change
    belong into a table kept by ``upsert_stream`` and summed when read.
    """
    instants = rows.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return (
        instants.withWatermark(ts_col, delay)
        .groupBy(*by, F.window(ts_col, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(value_col).alias("total"))
        .select(*by, F.col("w.start").alias(ts_col), "row_count", "total")
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
