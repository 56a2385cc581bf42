"""A corpus pipeline of five stages: toxicity, lines, near copies, benchmarks, mixing.

Every stage takes the documents its predecessor kept and returns documents; ``run``
writes each stage's result to the shared folder and reads it back for the next. Null
texts count as empty, rows without doc_id are rows like others, texts of any length are
taken whole, columns beyond those of documents are carried along whatever their names,
and an empty table gives an empty result. Ties are settled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.llm import decontaminate, jaccard_join, line_dedup, mixing, queries, toxicity
from pricegrid.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; emptied documents go."""
    return line_dedup.dedup_lines(docs)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest doc_id."""
    return jaccard_join.one_per_component(docs)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen for the target weights, each with its domain, tokens and copies.

    Columns of the documents with these three names are replaced, all others are kept.
    """
    chosen = mixing.mix(docs, None, queries.WEIGHTS, queries.levels(), queries.MIX_EPOCHS, queries.MIX_SEED)
    added = ["domain", "tokens", "copies"]
    picked = chosen.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.struct(F.first("domain").alias("domain"), F.first("tokens").alias("tokens"), F.max("copies").alias("copies")).alias("p")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    joined = rows.join(picked, F.col("d.doc_id").cast("long").eqNullSafe(F.col("id")))
    own = [F.col("d").getField(c).alias(c) for c in docs.columns if c not in added]
    return joined.select(*own, *[F.col("p").getField(c).alias(c) for c in added])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_near_copies),
    ("decontamination", drop_benchmarks),
    ("mixing", mix_sources),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}
