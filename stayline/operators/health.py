"""Pipeline health as long metric tables: (metric, value, alert)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayline.operators.running import moments_of, quantile_row, quantile_row_of, value_table
from stayline.schemas import FEATURES, LOG_FEATURES, MEMBER_FEATURES, TXN_FEATURES

# Default alert thresholds.
MIN_COHORT = 100
MAX_NULL_RATE = 0.99
MAX_CHURN_RATE = 0.5
MIN_AUC_PR = 0.45


def metric_table(one_row: DataFrame, metrics: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """Turn a one-row result into metric rows; an undefined condition is no alert."""
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            value.cast("double").alias("value"),
            F.coalesce(alert if alert is not None else F.lit(False), F.lit(False)).alias("alert"),
        )
        for name, (value, alert) in metrics.items()
    ]
    return one_row.select(F.inline(F.array(*rows)))


def _null_rate(columns: list[str]) -> Column:
    """Mean of the per-column null rates: NULLs per row, averaged as integers."""
    nulls = F.lit(0)
    for c in columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    return F.avg(nulls) / F.lit(float(len(columns)))


def serving_health(scored: DataFrame, rows_written: int | Column) -> DataFrame:
    """Cohort size, null rates, score and tier distribution of one scoring run.

    ``scored`` carries the features, ``score`` and ``risk_tier``. It is read twice, so pass a
    stored frame, as the scoring job does.
    """
    written = F.lit(rows_written) if isinstance(rows_written, int) else rows_written
    q = quantile_row(scored, "score", {"p50": 0.5, "p90": 0.9}).select(F.struct("p50", "p90")).scalar()
    tier = lambda name: F.coalesce(F.avg((F.col("risk_tier") == name).cast("int")), F.lit(0.0))
    one = scored.agg(
        F.count(F.lit(1)).alias("n"),
        _null_rate(FEATURES).alias("null_all"),
        _null_rate(TXN_FEATURES).alias("null_txn"),
        _null_rate(LOG_FEATURES).alias("null_log"),
        _null_rate(MEMBER_FEATURES).alias("null_member"),
        F.avg("score").alias("mean"),
        tier("HIGH").alias("high"),
        tier("MED").alias("med"),
        tier("LOW").alias("low"),
    )
    c = F.col
    return metric_table(
        one,
        {
            "cohort_size": (c("n"), c("n") < MIN_COHORT),
            "null_rate_overall": (c("null_all"), c("null_all") > MAX_NULL_RATE),
            "null_rate_txn": (c("null_txn"), None),
            "null_rate_log": (c("null_log"), None),
            "null_rate_member": (c("null_member"), None),
            "score_mean": (c("mean"), None),
            "score_p50": (q.getField("p50"), None),
            "score_p90": (q.getField("p90"), None),
            "high_tier_pct": (c("high"), None),
            "med_tier_pct": (c("med"), None),
            "low_tier_pct": (c("low"), None),
            "rows_written": (written, None),
        },
    )


def score_distribution(scored: DataFrame) -> DataFrame:
    """Number, range, mean and quantiles of the scores, in one row."""
    counts = value_table(scored, ["score"])
    stats = moments_of(counts).agg(
        F.struct(F.max("n").alias("n"), F.max("mean").alias("mean"))
    ).scalar()
    named = {"min": 0.0, "max": 1.0, "p50": 0.5, "p90": 0.9}
    return quantile_row_of(counts, named).select(
        F.coalesce(stats.getField("n"), F.lit(0).cast("bigint")).alias("n_users"),
        "min",
        "max",
        stats.getField("mean").alias("mean"),
        "p50",
        "p90",
    )


def labeling_health(labels: DataFrame, rows_written: int | Column | None = None) -> DataFrame:
    one = labels.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("is_churn"), F.lit(0.0)).alias("rate"))
    c = F.col
    written = c("n") if rows_written is None else rows_written
    written = F.lit(written) if isinstance(written, int) else written
    return metric_table(
        one,
        {
            "cohort_size": (c("n"), c("n") < MIN_COHORT),
            "labels_written": (written, None),
            "churn_rate": (c("rate"), c("rate") > MAX_CHURN_RATE),
        },
    )


def split_summary(rows: DataFrame) -> DataFrame:
    """Size and churn rate of each split."""
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_churn").alias("churned"),
        F.avg("is_churn").alias("churn_rate"),
    )


def training_health(metrics: DataFrame, sizes: DataFrame) -> DataFrame:
    """Validation metrics of a fit, with the auc_pr alert, and the split sizes.

    ``metrics`` is the one-row ``ranking_metrics`` result on the validation split and
    ``sizes`` a ``split_summary``.
    """
    size = lambda name: sizes.where(F.col("split") == name).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    c = F.col
    return metric_table(
        metrics,
        {
            "val_auc_pr": (c("auc_pr"), c("auc_pr") < MIN_AUC_PR),
            "val_auc_roc": (c("auc_roc"), None),
            "precision_at_k": (c("precision_at_k"), None),
            "recall_at_k": (c("recall_at_k"), None),
            "n_train": (size("train"), None),
            "n_val": (size("val"), None),
        },
    )


def validation_health(decision: DataFrame) -> DataFrame:
    """The candidate decision as metric rows; a missing production value counts as 0."""
    c = F.col
    return metric_table(
        decision,
        {
            "test_auc_pr_candidate": (c("test_auc_pr_candidate"), None),
            "test_auc_roc_candidate": (c("test_auc_roc_candidate"), None),
            "precision_at_k_candidate": (c("precision_at_k_candidate"), None),
            "recall_at_k_candidate": (c("recall_at_k_candidate"), None),
            "test_auc_pr_production": (F.coalesce(c("test_auc_pr_production"), F.lit(0.0)), None),
            "promoted_to_challenger": (c("promoted").cast("int"), None),
        },
    )
