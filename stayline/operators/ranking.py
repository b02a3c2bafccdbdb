"""Exact ranking metrics over any number of scored users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stayline.functions.numbers import ratio
from stayline.operators.running import running_sums
from stayline.session import stage


def top_k(scored: DataFrame, k: int = 100, then: list[str] | None = None) -> DataFrame:
    """The k highest scores; equal scores are ordered by user id, then by the columns ``then``."""
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")
    return scored.orderBy(F.desc("score"), F.asc("msno"), *(then or [])).limit(k)


def _areas(rows: DataFrame, by: list[str], parts: int | None) -> DataFrame:
    """Per group of ``by``: step-wise average precision and ROC area before division, positives and negatives."""
    hit = F.col("is_churn").cast("bigint")
    per_score = rows.groupBy(*by, "score").agg(F.sum(hit).alias("tp"), F.sum(1 - hit).alias("fp"))
    return running_sums(per_score, "score", ["tp", "fp"], parts, by).groupBy(*by).agg(
        F.sum(F.col("tp") * ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp"))).alias("_ap"),
        F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2)).alias("_auc"),
        F.coalesce(F.sum("tp"), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum("fp"), F.lit(0)).alias("_neg"),
    )


def average_precision_by(scored: DataFrame, by: list[str], parts: int | None = None) -> DataFrame:
    """(by, auc_pr) of every series at once, from (score, is_churn) and the columns ``by``.

    auc_pr is NULL for a series without both classes.
    """
    rows = scored.select(*by, F.col("score").cast("double").alias("score"), "is_churn")
    both = (F.col("_pos") > 0) & (F.col("_neg") > 0)
    return _areas(rows, by, parts).select(*by, F.when(both, ratio(F.col("_ap"), F.col("_pos"))).alias("auc_pr"))


def ranking_metrics(scored: DataFrame, k: int = 100, parts: int | None = None) -> DataFrame:
    """One row: auc_pr, auc_roc, precision_at_k, recall_at_k, n_total, n_churned, top_k.

    Input is (msno, score, is_churn). auc_pr is step-wise average precision with tied scores
    merged; auc_roc gives half credit to ties. Both are NULL unless both classes occur.
    """
    rows = scored.select("msno", F.col("score").cast("double").alias("score"), "is_churn")
    scored = stage(rows, "scored")  # read twice, and a score may be dear to compute
    areas = _areas(scored, [], parts)
    head = top_k(scored, k).agg(
        F.struct(
            F.avg("is_churn").alias("precision"),
            F.coalesce(F.sum(F.col("is_churn").cast("bigint")), F.lit(0)).alias("hits"),
        )
    ).scalar()
    pos, neg = F.col("_pos"), F.col("_neg")
    both = (pos > 0) & (neg > 0)
    pairs = pos.cast("double") * neg.cast("double")
    return areas.select(
        F.when(both, ratio(F.col("_ap"), pos)).alias("auc_pr"),
        F.when(both, F.try_divide(F.col("_auc"), pairs)).alias("auc_roc"),
        head.getField("precision").alias("precision_at_k"),
        F.coalesce(ratio(head.getField("hits"), pos), F.lit(0.0)).alias("recall_at_k"),
        (pos + neg).alias("n_total"),
        pos.alias("n_churned"),
        F.lit(k).alias("top_k"),
    )


def ranking_metrics_by(scored: DataFrame, by: list[str], k: int = 100, parts: int | None = None) -> DataFrame:
    """:func:`ranking_metrics` of every series at once: a row per group of the columns ``by``.

    Input is (msno, score, is_churn) and ``by``, for instance model version and month. All
    curves come from one pass: (series, score) is grouped and range-partitioned, so neither a
    series with most of the rows nor many small ones end in one task. NULL names a series too.
    ``k`` rows of each series are found by a window whose groups are cut to ``k`` rows before
    the shuffle.
    """
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")
    hit = F.col("is_churn").cast("bigint")
    rows = scored.select(*by, "msno", F.col("score").cast("double").alias("score"), "is_churn")
    areas = _areas(rows, by, parts)
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("msno"))
    head = rows.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k).groupBy(*[F.col(c).alias(f"_k_{c}") for c in by]).agg(
        F.avg("is_churn").alias("_precision"), F.sum(hit).alias("_hits")
    )
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    pos, neg = F.col("_pos"), F.col("_neg")
    both = (pos > 0) & (neg > 0)
    return areas.join(head, same).select(
        *by,
        F.when(both, ratio(F.col("_ap"), pos)).alias("auc_pr"),
        F.when(both, F.try_divide(F.col("_auc"), pos.cast("double") * neg.cast("double"))).alias("auc_roc"),
        F.col("_precision").alias("precision_at_k"),
        F.coalesce(ratio(F.col("_hits"), pos), F.lit(0.0)).alias("recall_at_k"),
        (pos + neg).alias("n_total"),
        pos.alias("n_churned"),
        F.lit(k).alias("top_k"),
    )


def cohort_performance(
    predictions: DataFrame, labels: DataFrame, k: int = 100, alert_below: float = 0.45
) -> DataFrame:
    """Metrics of stored scores against labels, with the retrain decision.

    The join is on the user: filter both sides to the same cohort month first. An empty
    match gives n_total = 0 and no alert.
    """
    if not 0.0 < alert_below < 1.0:
        raise ValueError(f"alert_below must be in (0, 1), got {alert_below}")
    joined = predictions.select("msno", "score").join(labels.select("msno", "is_churn"), "msno")
    return ranking_metrics(joined, k).withColumn(
        "auc_pr_alert", F.coalesce(F.col("auc_pr") < alert_below, F.lit(False))
    )


def candidate_decision(candidate: DataFrame, production: DataFrame | None, k: int = 100) -> DataFrame:
    """Promote the candidate iff its auc_pr is strictly greater on the same test rows.

    Inputs are (msno, score, is_churn). Without a production model, or without a defined
    production metric, the candidate is promoted.
    """
    cand = ranking_metrics(candidate, k).select(
        F.col("auc_pr").alias("test_auc_pr_candidate"),
        F.col("auc_roc").alias("test_auc_roc_candidate"),
        F.col("precision_at_k").alias("precision_at_k_candidate"),
        F.col("recall_at_k").alias("recall_at_k_candidate"),
    )
    if production is None:
        return cand.select("*", F.lit(0.0).alias("test_auc_pr_production"), F.lit(True).alias("promoted"))
    production_auc = ranking_metrics(production, k).select("auc_pr").scalar()
    return cand.withColumn("test_auc_pr_production", production_auc).withColumn(
        "promoted",
        F.col("test_auc_pr_production").isNull()
        | F.coalesce(F.col("test_auc_pr_candidate") > F.col("test_auc_pr_production"), F.lit(False)),
    )
