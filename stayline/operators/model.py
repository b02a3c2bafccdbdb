"""Churn classifier on Spark ML, and scoring with any other model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from stayline.operators.checks import in_unit_interval
from stayline.operators.growing import Growth, Layout, fit_trees
from stayline.operators.labels import class_ratio
from stayline.operators.ranking import average_precision_by
from stayline.schemas import CATEGORICAL_FEATURES, FEATURES, require_columns

NUMERIC = [c for c in FEATURES if c not in CATEGORICAL_FEATURES]

# Fit settings (learning rate, smallest leaf, row and feature shares).
STEP_SIZE = 0.05
MIN_LEAF_ROWS = 20
ROW_SHARE = 0.8
FEATURE_SHARE = "0.8"
ABSENT = -1.0  # stands for a missing number, beside its flag


def encode(df: DataFrame) -> DataFrame:
    """Make absence visible: trees here take no NaN, and absence is not zero.

    Numeric features get a sentinel outside their range plus a missing flag; categorical
    ones become strings with a category of their own for NULL.
    """
    return df.withColumns(
        {f"{c}_num": F.coalesce(F.col(c).cast("double"), F.lit(ABSENT)) for c in NUMERIC}
        | {f"{c}_isnull": F.col(c).isNull().cast("double") for c in NUMERIC}
        | {f"{c}_cat": F.coalesce(F.col(c).cast("string"), F.lit("missing")) for c in CATEGORICAL_FEATURES}
    )


def _assembly() -> tuple[list, list[str]]:
    indexers = StringIndexer(
        inputCols=[f"{c}_cat" for c in CATEGORICAL_FEATURES],
        outputCols=[f"{c}_idx" for c in CATEGORICAL_FEATURES],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    inputs = [f"{c}_num" for c in NUMERIC] + [f"{c}_isnull" for c in NUMERIC]
    inputs += [f"{c}_idx" for c in CATEGORICAL_FEATURES]
    return [indexers, VectorAssembler(inputCols=inputs, outputCol="features")], inputs


def _boosted(train: DataFrame, assembly: Pipeline, gbt: GBTClassifier, pos_weight: float) -> PipelineModel:
    """The pipeline with the trees that ``gbt`` describes, grown by :mod:`stayline.operators.growing`.

    Each number is cut at quantiles of all its values; absence takes one more of Spark's bins.
    """
    from stayline.operators.boosting import find_bins  # which takes constants from this module

    prepared = assembly.fit(train)
    bins = gbt.getMaxBins()
    cuts = find_bins(train, NUMERIC, [], bins - 1).edges
    arity = tuple(len(values) + 1 for values in prepared.stages[0].labelsArray)  # one for values not seen in the fit
    if max(arity) > bins:
        raise ValueError(f"a category has {max(arity)} values, more than {bins} bins")
    layout = Layout(tuple(tuple(sorted({*c, ABSENT})) for c in cuts), arity, ABSENT)
    growth = Growth(
        rounds=gbt.getMaxIter(), depth=gbt.getMaxDepth(), step=gbt.getStepSize(), min_rows=gbt.getMinInstancesPerNode(),
        row_share=gbt.getSubsamplingRate(), feature_share=float(gbt.getFeatureSubsetStrategy()), seed=gbt.getSeed() % (1 << 64), pos_weight=pos_weight,
    )
    indexed = prepared.stages[0].transform(train)
    numbers = [F.col(c).cast("double").alias(c) for c in NUMERIC]
    rows = indexed.select(*numbers, *[F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in CATEGORICAL_FEATURES], "label")
    return PipelineModel([*prepared.stages, fit_trees(rows, layout, growth, gbt)])


def best_prefix(losses: list[float], patience: int) -> int:
    """Rounds to keep: those up to the smallest loss seen before ``patience`` rounds passed without a smaller one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_gbt(
    rows: DataFrame,
    scale_pos_weight: float | None = None,
    rounds: int = 100,
    depth: int = 6,
    patience: int = 50,
    seed: int = 42,
    stop_on: str = "auc_pr",
) -> PipelineModel:
    """Gradient-boosted trees on the train split, cut back to the best number of rounds on the val split.

    ``rows`` has the features, ``is_churn`` and ``split``. The positive-class weight is
    retained over churned of the train split unless given. Spark's own early stop has no
    patience, so all rounds are fitted; one job then gives the average precision of the val
    split after every round (``stop_on="auc_pr"``), or one pass its weighted log loss
    (``"log_loss"``), and :func:`best_prefix` says where to cut. Without a val split, or with
    one class in it, all rounds stay.
    """
    if stop_on not in ("auc_pr", "log_loss"):
        raise ValueError(f"unknown measure {stop_on!r}")
    require_columns(rows, FEATURES + ["is_churn", "split"], "rows")
    if scale_pos_weight is None:
        train = rows.where("split = 'train'")
        scale_pos_weight = float(class_ratio(train).first()["scale_pos_weight"]) or 1.0
    weighted = encode(rows.where(F.col("split").isin("train", "val"))).select(
        "*",
        F.col("is_churn").cast("double").alias("label"),
        F.when(F.col("is_churn") == 1, F.lit(scale_pos_weight)).otherwise(F.lit(1.0)).alias("weight"),
    )
    stages, _ = _assembly()
    gbt = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=STEP_SIZE,
        minInstancesPerNode=MIN_LEAF_ROWS,
        subsamplingRate=ROW_SHARE,
        featureSubsetStrategy=FEATURE_SHARE,
        seed=seed,
    )
    fitted = _boosted(weighted.where("split = 'train'"), Pipeline(stages=stages), gbt, scale_pos_weight)
    val = weighted.where("split = 'val'")
    if val.isEmpty():
        return fitted
    prepared = PipelineModel(fitted.stages[:-1]).transform(val)
    if stop_on == "log_loss":
        losses = list(fitted.stages[-1].evaluateEachIteration(prepared))
    else:
        curve = average_precision_by(margins_by_round(fitted.stages[-1], prepared), ["round"]).orderBy("round").collect()
        if any(r.auc_pr is None for r in curve):
            return fitted
        losses = [-r.auc_pr for r in curve]
    keep = best_prefix(losses, patience)
    return PipelineModel([*fitted.stages[:-1], first_rounds(fitted.stages[-1], keep)])


def margins_by_round(model: GBTClassificationModel, prepared: DataFrame) -> DataFrame:
    """(round, score, is_churn): each row's margin after every number of trees, from one pass.

    Rounds count from 1. ``prepared`` has the assembled ``features``. Rows multiply by the
    rounds, so whatever follows should first combine equal scores.
    """
    # A leaf's number is its place from left to right, the order of the printed predictions.
    leaves = [[float(v) for v in re.findall(r"Predict: (\S+)", tree.toDebugString)] for tree in model.trees]
    values = np.zeros((len(leaves), max(map(len, leaves))))
    for i, (found, weight) in enumerate(zip(leaves, model.treeWeights)):
        values[i, : len(found)] = np.array(found) * weight

    @F.pandas_udf("array<double>")
    def margins(places: pd.Series) -> pd.Series:
        if places.empty:
            return pd.Series([], dtype=object)
        at = np.stack(places.to_numpy()).astype(np.int64)
        return pd.Series(list(np.cumsum(values[np.arange(len(values)), at], axis=1)))

    only_leaves = {model.leafCol: "_leaves", model.predictionCol: "", model.probabilityCol: "", model.rawPredictionCol: ""}
    rows = model.copy(only_leaves).transform(prepared.select("features", "is_churn"))
    after = rows.select("is_churn", margins(vector_to_array("_leaves")).alias("_margins"))
    return after.select(F.posexplode("_margins").alias("_i", "score"), "is_churn").select((F.col("_i") + 1).alias("round"), "score", "is_churn")


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees."""
    if rounds >= model.getNumTrees:
        return model
    sc, java = SparkContext.getOrCreate(), model._java_obj
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], float(java.treeWeights()[i])
    short = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses()
    )
    return GBTClassificationModel(java.copyValues(short, sc._jvm.org.apache.spark.ml.param.ParamMap()) and short)


def score(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``score``, the probability of churn; a value outside [0, 1] fails the job."""
    probability = vector_to_array("probability")[1]
    return model.transform(encode(rows)).select(*rows.columns, in_unit_interval(probability).alias("score"))


def score_with(rows: DataFrame, load: Callable[[], Any], columns: list[str] | None = None) -> DataFrame:
    """Score with any object that has ``predict_proba`` or ``predict``.

    ``load`` runs once per task; batches arrive as Arrow-backed pandas frames.
    """
    columns = columns or FEATURES
    require_columns(rows, columns, "rows")

    def predict(batches: Iterator) -> Iterator:
        model = load()
        for batch in batches:
            x = batch[columns]
            if hasattr(model, "predict_proba"):
                p = model.predict_proba(x)
                p = p[:, 1] if getattr(p, "ndim", 1) == 2 else p
            else:
                p = model.predict(x)
            if len(p) != len(batch):
                raise ValueError(f"model returned {len(p)} scores for {len(batch)} rows")
            yield batch.assign(score=p)

    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.mapInPandas(predict, schema).withColumn("score", in_unit_interval(F.col("score")))


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance) of the fitted trees; a feature's missing flag counts for it.

    The vector is one number per model input, so it is small by construction.
    """
    _, inputs = _assembly()
    totals: dict[str, float] = {}
    for name, value in zip(inputs, model.stages[-1].featureImportances.toArray()):
        totals[name.rsplit("_", 1)[0]] = totals.get(name.rsplit("_", 1)[0], 0.0) + float(value)
    spark = rows.sparkSession
    return spark.createDataFrame(sorted(totals.items()), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
