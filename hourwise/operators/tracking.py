"""Experiment runs and model versions as plain tables.

A run store is three Parquet tables in a shared folder: ``runs`` (run_id,
parent_id, experiment, task, algorithm), ``run_params`` (run_id, key, value)
and ``run_metrics`` (run_id, key, value, step). Logging appends DataFrames
(metric tables produced by Spark jobs are unpivoted, never collected); the
leaderboard and the registry are queries over those tables.
"""
from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, parent_id string, experiment string, task string, algorithm string"


def run_id(experiment: str, task: str, algorithm: str) -> str:
    """Deterministic run id: md5 of experiment/task/algorithm."""
    return hashlib.md5(f"{experiment}/{task}/{algorithm}".encode()).hexdigest()


def log_run(store: str, metrics: DataFrame, experiment: str, task: str, algorithm: str,
            params: Mapping[str, object] | None = None, parent: str | None = None,
            step_col: str | None = None) -> None:
    """Append one run: its row, its params and every numeric column of
    ``metrics`` as (key, value, step) rows."""
    spark = metrics.sparkSession
    rid = F.lit(run_id(experiment, task, algorithm))
    one = spark.range(1)
    one.select(rid.alias("run_id"), F.lit(parent).cast("string").alias("parent_id"), F.lit(experiment).alias("experiment"),
               F.lit(task).alias("task"), F.lit(algorithm).alias("algorithm")) \
       .write.mode("append").parquet(f"{store}/runs")
    if params:
        kv = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(str(v)).alias("value")) for k, v in params.items()])
        one.select(rid.alias("run_id"), F.explode(kv).alias("p")).select("run_id", "p.*") \
           .write.mode("append").parquet(f"{store}/run_params")
    numeric = [f.name for f in metrics.schema.fields
               if f.dataType.typeName() in ("double", "float", "integer", "long") and f.name != step_col]
    kv = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in numeric])
    step = F.col(step_col).cast("long") if step_col else F.lit(0).cast("long")
    metrics.select(rid.alias("run_id"), step.alias("step"), F.explode(kv).alias("m")) \
           .select("run_id", F.col("m.key").alias("key"), F.col("m.value").alias("value"), "step") \
           .write.mode("append").parquet(f"{store}/run_metrics")


def read_store(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{store}/runs"), spark.read.parquet(f"{store}/run_metrics")


def run_leaderboard(runs: DataFrame, metrics: DataFrame, metric_names: Sequence[str]) -> DataFrame:
    """Child runs only, one column per metric (value at the last step), sorted by
    task and algorithm. The pivot uses an explicit value list."""
    last = metrics.groupBy("run_id", "key").agg(F.max_by("value", "step").alias("value"))
    wide = last.groupBy("run_id").pivot("key", list(metric_names)).agg(F.first("value"))
    child = runs.filter(F.col("parent_id").isNotNull()).select("run_id", "task", "algorithm")
    return child.join(wide, "run_id", "left").orderBy("task", "algorithm")


def alias_table(metrics_by_version: DataFrame, score: str = "f1_score", baseline: str = "v1_baseline") -> DataFrame:
    """(alias, version): 'champion' is the version with the best ``score`` (the first on ties), 'baseline' always
    the version named ``baseline``, also where it is the champion."""
    champion = metrics_by_version.agg(F.min_by("version", F.struct(-F.col(score), F.col("version"))).alias("version"))
    base = metrics_by_version.filter(F.col("version") == baseline).select("version")
    return champion.select(F.lit("champion").alias("alias"), "version") \
                   .unionByName(base.select(F.lit("baseline").alias("alias"), "version"))


def version_of(aliases: DataFrame, alias: str) -> str:
    """The version an alias points to; a missing alias raises."""
    row = aliases.filter((F.col("alias") == alias) & F.col("version").isNotNull()).select("version").first()
    if row is None:
        raise LookupError(f"no model version has the alias {alias!r}")
    return row["version"]


def register_versions(metrics_by_version: DataFrame, score: str = "f1_score", baseline: str = "v1_baseline") -> DataFrame:
    """Registry table: registered_version numbers in version order and one alias a row for display: 'champion'
    for the version that ``alias_table`` gives it, 'baseline' for the other."""
    from pyspark.sql import Window
    w = Window.orderBy("version")
    champ = alias_table(metrics_by_version, score, baseline).filter(F.col("alias") == "champion").select(F.col("version").alias("_champ"))
    return (metrics_by_version.crossJoin(F.broadcast(champ))                                   # one row
            .withColumn("registered_version", F.row_number().over(w))
            .withColumn("alias", F.when(F.col("version") == F.col("_champ"), "champion").otherwise("baseline"))
            .drop("_champ"))


def version_comparison(registry: DataFrame, metric_names: Sequence[str] = ("accuracy", "precision", "recall",
                                                                           "f1_score", "roc_auc")) -> DataFrame:
    """Long form: (version, metric, value)."""
    return registry.unpivot(["version"], list(metric_names), "metric", "value")


def alias_join(scored: DataFrame, registry: DataFrame, aliases: DataFrame, alias: str = "champion",
               model_name: str = "high_risk_classifier") -> DataFrame:
    """Attach name, version and alias to scores of the model that the alias points to (one row,
    broadcast). A missing alias raises."""
    version = version_of(aliases, alias)
    pick = registry.filter(F.col("version") == version).select(
        F.lit(model_name).alias("model_name"), F.col("registered_version").alias("model_version"),
        F.lit(alias).alias("model_alias"))
    return scored.crossJoin(F.broadcast(pick))
