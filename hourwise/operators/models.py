"""Model fits as Spark ML pipelines (distributed training), scoring and the
tables around them (predicted vs actual, model comparison, training history).

Equivalences with the reference's scikit-learn settings
-------------------------------------------------------
* logistic, C = 1, balanced classes: sklearn minimises Σ wᵢ·lossᵢ + ½‖β‖²/C;
  Spark minimises Σ wᵢ·lossᵢ / Σ wᵢ + λ/2‖β‖². With balanced weights Σ wᵢ = n,
  so λ = 1/(C·n). Features are standardised in the pipeline (Spark's scaler
  uses the sample std, sklearn's the population std: a √((n−1)/n) factor).
* random forests: numTrees / maxDepth / minInstancesPerNode / seed as given;
  sklearn's classifier samples √p features per split ("sqrt"), its regressor
  all of them ("all"). Spark bins continuous features (maxBins = 32), so
  results are close to, not equal to, sklearn's.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import COMMON_FEATURE_COLUMNS
from .evaluation import classification_metrics, regression_metrics, with_class_weight

SEED = 42
# --- fixed values: rounds, patience and least improvement of the forecaster ---
MAX_ROUNDS, PATIENCE, MIN_DELTA = 40, 6, 1e-6
# -----------------------------------------------------------------------------


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep")


def logistic_pipeline(n_rows: int, features: Sequence[str] = COMMON_FEATURE_COLUMNS, label: str = "high_risk",
                      c: float = 1.0, max_iter: int = 1000) -> Pipeline:
    return Pipeline(stages=[
        _assembler(features),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter,
                           regParam=1.0 / (c * max(n_rows, 1)), elasticNetParam=0.0, standardization=False)])


def rf_classifier_pipeline(features: Sequence[str] = COMMON_FEATURE_COLUMNS, label: str = "high_risk",
                           num_trees: int = 150, max_depth: int = 10, min_leaf: int = 5) -> Pipeline:
    return Pipeline(stages=[
        _assembler(features).setOutputCol("features"),
        RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", numTrees=num_trees,
                               maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=SEED,
                               featureSubsetStrategy="sqrt")])


def linear_pipeline(features: Sequence[str] = COMMON_FEATURE_COLUMNS, label: str = "traffic_volume") -> Pipeline:
    return Pipeline(stages=[
        _assembler(features),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, standardization=False)])


def rf_regressor_pipeline(features: Sequence[str] = COMMON_FEATURE_COLUMNS, label: str = "traffic_volume",
                          num_trees: int = 150, max_depth: int = 10, min_leaf: int = 5) -> Pipeline:
    return Pipeline(stages=[
        _assembler(features).setOutputCol("features"),
        RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                              minInstancesPerNode=min_leaf, seed=SEED, featureSubsetStrategy="all")])


def early_stop(losses: Sequence[float], patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> tuple[int, int]:
    """(last round that runs, best round), counted from 1: a round improves if its loss is below the best by more than
    ``min_delta``; after ``patience`` rounds in a row that do not, training ends."""
    best, best_round = float("inf"), 0
    for n, loss in enumerate(losses, 1):
        if loss < best - min_delta:
            best, best_round = loss, n
        elif n - best_round >= patience:
            return n, max(best_round, 1)
    return len(losses), max(best_round, 1)


def fit_forecaster(train: DataFrame, val: DataFrame, features: str = "features", label: str = "target",
                   max_rounds: int = MAX_ROUNDS, patience: int = PATIENCE) -> tuple[GBTRegressionModel, DataFrame]:
    """Next-hour forecast from a vector column (re-aim of the sequence network): boosting rounds play the role of epochs. Returns the
    model of the best round by validation loss, and the history: epoch, train_loss, val_loss, best_epoch of every round that ran.
    Boosting adds trees one by one, so all rounds are fitted first, the rule of ``early_stop`` is read off the two loss curves (at most
    ``max_rounds`` numbers each), and the best round's model is the same fit with so many rounds. No train or validation row raises."""
    for name, rows in (("train", train), ("validation", val)):
        if not rows.limit(1).take(1):
            raise ValueError(f"no {name} row: no block of readings is long enough for a window")

    def boosted(rounds: int) -> GBTRegressionModel:
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=5, stepSize=0.1, seed=SEED).fit(train)
    model = boosted(max_rounds)
    losses = [model.evaluateEachIteration(rows, "squared") for rows in (train, val)]
    last, best = early_stop(losses[1], patience)
    if best < max_rounds:
        model = boosted(best)
    history = train.sparkSession.createDataFrame(
        [(n, float(a), float(b), best) for n, (a, b) in enumerate(zip(*losses), 1) if n <= last],
        "epoch int, train_loss double, val_loss double, best_epoch int")
    return model, history


def fit_classifier(pipeline: Pipeline, train: DataFrame, label: str = "high_risk") -> PipelineModel:
    """Fit with balanced class weights (n / (2·n_c) joined from a two-row table)."""
    return pipeline.fit(with_class_weight(train, label, "weight"))


def predict_score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """prediction and P(class 1) per row."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("score"))


def predict_value(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return model.transform(df).select(*keep, F.col("prediction").alias("prediction"))


def predicted_vs_actual(scored: dict[str, DataFrame], actual: str = "actual") -> DataFrame:
    """Long (model, actual, predicted) table with the plot's axis limit (max × 1.02)."""
    parts = [df.select(F.lit(name).alias("model"), F.col(actual).cast("double").alias("actual"),
                       F.col("prediction").cast("double").alias("predicted")) for name, df in scored.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    lim = out.agg((F.greatest(F.max("actual"), F.max("predicted")) * 1.02).alias("axis_limit"))
    return out.crossJoin(F.broadcast(lim))


def classification_comparison(scored: dict[str, DataFrame], label: str = "label") -> DataFrame:
    parts = [classification_metrics(df, label, "prediction", "score").withColumn("model", F.lit(name))
             for name, df in scored.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "accuracy", "precision", "recall", "f1", "roc_auc")


def regression_comparison(scored: dict[str, DataFrame], actual: str = "actual") -> DataFrame:
    parts = [regression_metrics(df, actual, "prediction").withColumn("model", F.lit(name))
             for name, df in scored.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "mae", "rmse", "r2")
