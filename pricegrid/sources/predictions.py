"""Prediction records: JSON for the dashboard, Parquet per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.schemas import PREDICTION_SCHEMA

# fixed value: written form of an instant
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ssXXX"
FIELDS = ["predicted_price", "mode", "actual_price", "error", "abs_error"]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Records from a JSON array or from JSON lines, sorted by time."""
    rows = (
        spark.read.schema(PREDICTION_SCHEMA).option("multiLine", True).json(path)
        if path.endswith(".json")
        else spark.read.schema(PREDICTION_SCHEMA).json(path)
    )
    return rows.select(
        F.to_timestamp("timestamp", STAMP_FORMAT).alias("ts"), *FIELDS
    ).orderBy("ts")


def write_predictions(df: DataFrame, root: str, run_ts: str, ts_col: str = "ts") -> None:
    """Write one run as JSON lines below ``run_ts=...``; earlier runs stay.

    A finished run is entered into the small table of runs beside the records.
    """
    stamp = F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss")
    extra = [c for c in df.columns if c not in (ts_col, *FIELDS)]
    (
        df.select(*extra, F.concat(stamp, F.lit("+00:00")).alias("timestamp"), *FIELDS)
        .write.mode("overwrite")
        .json(f"{root}/run_ts={run_ts}")
    )
    df.sparkSession.range(1).select(F.lit(run_ts).alias("run_ts")).write.mode("append").parquet(runs_path(root))


def runs_path(root: str) -> str:
    return f"{root.rstrip('/')}_runs"


def latest_predictions(spark: SparkSession, root: str) -> DataFrame:
    """Records of the newest run; the other runs' folders are not read.

    The newest run comes from the table of runs, so the folder filter is known before
    any record is scanned.
    """
    rows = spark.read.schema(
        PREDICTION_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " ")
        + ", run_ts string"
    ).json(root)
    newest = spark.read.parquet(runs_path(root)).agg(F.max("run_ts")).scalar()
    return rows.where(F.col("run_ts") == newest).select(
        F.to_timestamp("timestamp", STAMP_FORMAT).alias("ts"), *FIELDS
    )
