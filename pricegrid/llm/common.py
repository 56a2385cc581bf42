"""Small helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.session import staged

__all__ = ["SHINGLE", "SIMILARITY", "signed", "staged", "table", "texts"]

#: Words in a shingle, and the least similarity of near copies as a fraction 75/100.
SHINGLE = 5
SIMILARITY = (75, 100)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, null texts as empty, whatever else the table has."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)
