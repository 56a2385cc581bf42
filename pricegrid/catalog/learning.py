"""Training and scoring; where values depend on the learner there is no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.catalog import views as v
from pricegrid.catalog.features import full_features_of
from pricegrid.catalog.features import FULL_SQL
from pricegrid.catalog.registry import query, rounded
from pricegrid.functions.errors import error_columns
from pricegrid.operators.reports import mode_label
from pricegrid.operators.splits import split_rows
from pricegrid.plans import models as m
from pricegrid.session import checkpointed


def _labelled(spark, sf):
    rows = split_rows(full_features_of(spark, sf), v.as_of(), chunk_hours=v.TEST_CHUNK)
    # Trees read their rows once per round; the checkpoint cuts the feature plan.
    return checkpointed(rows)


def _fit(rows):
    return m.train(rows)


@query("train_gbt")
def _train_gbt(spark, sf):
    rows = _labelled(spark, sf)
    scored = m.score(rows, _fit(rows), ["split", "price"])
    return m.metrics_by_split(
        scored.withColumnRenamed("price", "actual_price").withColumns(error_columns())
    )


@query("score_modes")
def _score_modes(spark, sf):
    rows = _labelled(spark, sf)
    return m.score_modes(mode_label(rows, v.as_of(), 7, 2), _fit(rows))


@query("feature_importance")
def _feature_importance(spark, sf):
    return m.importance(_fit(_labelled(spark, sf)), spark)


@query("linear_baseline")
def _linear_baseline(spark, sf):
    rows = _labelled(spark, sf)
    scored = m.score(rows, m.train(rows, family="linear"), ["split", "price"])
    return m.metrics_by_split(
        scored.select("split", F.col("price").alias("actual_price"), "predicted_price")
    )


LINEAR = ["price_lag_24h", "residual_load"]
LINEAR_TWIN = f"""WITH {FULL_SQL},
x AS (SELECT price AS y, coalesce(CAST({LINEAR[0]} AS DOUBLE), 0) AS a, coalesce(CAST({LINEAR[1]} AS DOUBLE), 0) AS b
  FROM full_features WHERE price IS NOT NULL AND ts < TIMESTAMP '{v.AS_OF}'),
s AS (SELECT avg(y) AS y, avg(a) AS a, avg(b) AS b, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
  covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM x),
c AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ca, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM s)
SELECT '{LINEAR[0]}' AS feature, {rounded("ca", "coefficient")} FROM c UNION ALL
SELECT '{LINEAR[1]}', {rounded("cb", "coefficient")} FROM c UNION ALL
SELECT 'intercept', {rounded("y - ca * a - cb * b", "coefficient")} FROM c"""


@query("linear_coefficients", LINEAR_TWIN)
def _linear_coefficients(spark, sf):
    """The linear family by its normal equations: one aggregate of products, solved on the driver."""
    rows = full_features_of(spark, sf).withColumn(
        "split", F.when(F.col("ts") < v.as_of(), "train").otherwise("test")
    )
    model = m.train(checkpointed(rows), LINEAR, family="linear", solver="normal")
    return m.coefficients(model, spark)
