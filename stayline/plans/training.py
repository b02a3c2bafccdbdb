"""Fit on a dataset version; compare a candidate with production on its test split."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.operators.health import split_summary, training_health, validation_health
from stayline.operators.model import fit_gbt, score
from stayline.operators.ranking import candidate_decision, ranking_metrics
from stayline.sources.readers import dataset_split


def train(
    spark: SparkSession, root: str, version: str, rounds: int = 100, k: int = 100, seed: int = 42
) -> tuple[PipelineModel, DataFrame]:
    """Model and health metrics. An empty train or test split is an error."""
    rows = spark.read.parquet(f"{root}/rows").where(F.col("dataset_version_id") == version)
    for split in ("train", "test"):
        if rows.where(F.col("split") == split).isEmpty():
            raise ValueError(f"dataset {version}: empty {split} split")
    model = fit_gbt(rows, rounds=rounds, seed=seed)
    metrics = ranking_metrics(score(rows.where("split = 'val'"), model), k)
    return model, training_health(metrics, split_summary(rows))


def validate(
    spark: SparkSession,
    root: str,
    version: str,
    candidate: PipelineModel,
    production: PipelineModel | None,
    k: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """(decision, health): both models on the test split neither has seen."""
    test = dataset_split(spark, root, version, "test")
    if test.isEmpty():
        raise ValueError(f"dataset {version}: empty test split")
    theirs = None if production is None else score(test, production)
    decision = candidate_decision(score(test, candidate), theirs, k)
    return decision, validation_health(decision)
