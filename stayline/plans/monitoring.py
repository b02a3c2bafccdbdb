"""Drift and performance checks on what was scored."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from stayline.functions.dates import as_int
from stayline.operators.drift import drift_alerts, drift_from
from stayline.operators.features import feature_matrix, with_cutoff
from stayline.operators.labels import labels_of_months
from stayline.operators.pit import staged_cohort
from stayline.operators.ranking import cohort_performance
from stayline.operators.reads import predictions_for_month, scored_users
from stayline.schemas import FEATURES
from stayline.session import stage
from stayline.sources.readers import dataset_params, drift_histograms


def run_drift(
    current: DataFrame, root: str, version: str, threshold: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """(psi per feature, alert row) of a scored frame against its model's dataset.

    Of the dataset only its stored histograms are read.
    """
    stored = drift_histograms(current.sparkSession, root, version)
    psi = stage(drift_from(stored, current, FEATURES), "psi")
    return psi, drift_alerts(psi, threshold)


def features_of_scored(
    predictions: DataFrame,
    scoring_date: date | str,
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    root: str,
    version: str,
    lag_days: int = 14,
) -> DataFrame:
    """Rebuild the features of a stored scoring date, with that dataset's threshold."""
    cohort = staged_cohort(with_cutoff(scored_users(predictions, scoring_date), lag_days))
    threshold = dataset_params(predictions.sparkSession, root, version).select("p99_secs").scalar()
    last = cohort.agg(F.max("feature_cutoff_date")).first()[0]
    bound = None if last is None else as_int(last)  # the scans need nothing later
    return stage(feature_matrix(cohort, txn, logs, members, threshold, bound), "drift-features")


def run_performance(
    predictions: DataFrame, labels: DataFrame, month: str, k: int = 100, alert_below: float = 0.45
) -> DataFrame:
    """Metrics of one cohort month with the alert, and whether to retrain.

    Without any prediction or label for the month there is nothing to compare: that is an
    alert, but no reason to retrain.
    """
    mine = stage(predictions_for_month(predictions, month), "month-predictions")
    truth = stage(labels_of_months(labels, [month]), "month-labels")
    missing = mine.isEmpty() or truth.isEmpty()
    out = cohort_performance(mine, truth, k, alert_below)
    return out.withColumn("retrain", F.col("auc_pr_alert")).withColumn(
        "auc_pr_alert", F.col("auc_pr_alert") | F.lit(missing)
    )
