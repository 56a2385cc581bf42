"""Training, scoring and comparing models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions.errors import error_columns
from pricegrid.operators.reports import metrics
from pricegrid.schemas import SERIES, TS

LABEL = "price"
FEATURES = "features"

# --- fixed values: default learning parameters ---
BOOSTED_TREES = {
    "maxDepth": 8,
    "stepSize": 0.05,
    "maxIter": 500,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 3,
    "minInfoGain": 0.1,
    "seed": 42,
}
FOREST = {
    "maxDepth": 8,
    "numTrees": 500,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 20,
    "seed": 42,
}
# --- end of fixed values ---

# Current-row changes contain the target itself and are no model inputs.
LEAKING = ("price_diff_1h", "price_diff_24h")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def input_columns(
    df: DataFrame, label: str = LABEL, exclude: Sequence[str] = LEAKING
) -> list[str]:
    """Model inputs: numeric columns without keys, label and leaking columns."""
    return numeric_columns(df, (SERIES, TS, label, *exclude))


def training_matrix(
    df: DataFrame,
    label: str = LABEL,
    features: Sequence[str] | None = None,
    keep: Sequence[str] = (SERIES, TS),
) -> DataFrame:
    """Rows with a label; features as double with nulls as 0."""
    names = list(features) if features is not None else input_columns(df, label)
    return df.where(F.col(label).isNotNull()).select(
        *keep,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names],
        label,
    )


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Select a model's features in order; absent ones and nulls become 0."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
            if c in have
            else F.lit(0.0).alias(c)
            for c in features
        ],
    )


def learner(family: str = "boosted_trees", **params):
    """A regressor by family name, defaults replaced by ``params``."""
    if family == "boosted_trees":
        return GBTRegressor(labelCol=LABEL, featuresCol=FEATURES, **{**BOOSTED_TREES, **params})
    if family == "forest":
        return RandomForestRegressor(labelCol=LABEL, featuresCol=FEATURES, **{**FOREST, **params})
    if family == "linear":
        return LinearRegression(labelCol=LABEL, featuresCol=FEATURES, **params)
    raise ValueError(f"unknown model family {family!r}")


def train(
    df: DataFrame,
    features: Sequence[str] | None = None,
    family: str = "boosted_trees",
    split_col: str = "split",
    validation_tol: float = 1e-4,
    **params,
) -> PipelineModel:
    """Fit on the rows labelled ``train``.

    Boosting stops early once another round improves the error on the rows
    labelled ``val`` by less than ``validation_tol``.
    """
    names = list(features) if features is not None else input_columns(df)
    used = ["train", "val"] if family == "boosted_trees" else ["train"]
    rows = df.where(F.col(split_col).isin(used))
    matrix = training_matrix(rows, features=names, keep=(split_col,)).withColumn(
        "__val", F.col(split_col) == "val"
    )
    if family == "boosted_trees":
        params = {"validationIndicatorCol": "__val", "validationTol": validation_tol, **params}
    stages = [VectorAssembler(inputCols=names, outputCol=FEATURES), learner(family, **params)]
    return Pipeline(stages=stages).fit(matrix)


def model_inputs(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus ``predicted_price``, without any join back."""
    names = model_inputs(model)
    kept = {f"__keep_{c}": F.col(c) for c in keep}
    aligned = align_features(df.withColumns(kept), names, list(kept))
    scored = model.transform(aligned)
    return scored.select(
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
        F.col("prediction").alias("predicted_price"),
    )


def score_modes(
    df: DataFrame, model: PipelineModel, keys: Sequence[str] = (SERIES, TS)
) -> DataFrame:
    """Score labelled rows (see ``mode_label``) and add the errors."""
    return score_modes_with(df, lambda rows, keep: score(rows, model, keep), keys)


def score_modes_with(
    df: DataFrame, scorer: Callable[[DataFrame, Sequence[str]], DataFrame], keys: Sequence[str] = (SERIES, TS)
) -> DataFrame:
    """``score_modes`` with any ``scorer(df, keep)`` that adds ``predicted_price``."""
    scored = scorer(df, [*keys, "mode", LABEL])
    return scored.withColumnRenamed(LABEL, "actual_price").withColumns(error_columns())


def importance(model: PipelineModel, spark: SparkSession, top: int | None = 10) -> DataFrame:
    """Feature names by importance; one row per feature, top 10 by default."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(
        list(zip(model_inputs(model), weights)), "feature string, importance double"
    ).orderBy(F.col("importance").desc(), "feature")
    return rows.limit(top) if top is not None else rows


def coefficients(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """``feature, coefficient`` of a linear model, and its ``intercept``."""
    last = model.stages[-1]
    rows = [*zip(model_inputs(model), last.coefficients.toArray().tolist()), ("intercept", float(last.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def metrics_by_split(scored: DataFrame, split_col: str = "split") -> DataFrame:
    return metrics(scored, [split_col])


def run_rows(
    by_split: DataFrame, model: str, feature_count: int, version: int | None = None
) -> DataFrame:
    """Registry rows from metrics per split, one per ``version`` of the input.

    Without such a column, all metrics belong to the given version.
    """
    rows = by_split if version is None else by_split.withColumn("version", F.lit(version))
    names = [
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
        for s in ("train", "val", "test")
        for m in ("mae", "rmse", "r2")
    ]
    samples = F.max(F.when(F.col("split") == "train", F.col("row_count")))
    return (
        rows.groupBy("version")
        .agg(*names, samples.alias("training_samples"))
        .withColumns(
            {
                "model": F.lit(model),
                "trained_at": F.current_timestamp(),
                "feature_count": F.lit(feature_count),
            }
        )
    )


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    path = f"{root.rstrip('/')}/{name}/version={version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, name: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/version={version}")


def register(run: DataFrame, path: str) -> None:
    run.coalesce(1).write.mode("append").parquet(path)


def best_run(runs: DataFrame, by: str = "test_mae") -> DataFrame:
    """The run with the lowest value, the newest version on a tie."""
    return runs.where(F.col(by).isNotNull()).orderBy(by, F.col("version").desc()).limit(1)


def newest_run(runs: DataFrame, model: str) -> DataFrame:
    return runs.where(F.col("model") == model).orderBy(F.col("version").desc()).limit(1)
