"""From stored labels to a versioned, split training dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.dates import as_int
from stayline.operators.features import feature_matrix, p99_secs, training_rows, with_cutoff
from stayline.operators.health import split_summary
from stayline.operators.labels import labels_of_months
from stayline.operators.pit import staged_cohort
from stayline.operators.splits import split_3way
from stayline.schemas import FEATURES
from stayline.session import stage
from stayline.sources.writers import write_dataset, write_histograms


def labeled_features(
    labels: DataFrame,
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    threshold: Column | float | None = None,
    last_cutoff: int | None = None,
) -> DataFrame:
    """Label, cohort month and all features of every labeled user.

    The winsor threshold is computed over the same users and cutoffs unless given, and
    enters the plan as a scalar subquery. Labels travel with the cohort, so no join is
    needed to put them next to the features.
    """
    cohort = labels.select("msno", "feature_cutoff_date", "anchor_expiry_date", "is_churn")
    if threshold is None:
        threshold = p99_secs(logs, cohort, last_cutoff).scalar()
    return training_rows(feature_matrix(cohort, txn, logs, members, threshold, last_cutoff, most_users=True))


def build_dataset(
    labels: DataFrame,
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    root: str,
    version: str,
    months: list[str] | None = None,
    val_fraction: float = 0.15,
    test_fraction: float = 0.15,
    lag_days: int = 14,
    seed: int = 42,
) -> DataFrame:
    """Write a dataset version and return its split sizes and churn rates."""
    cohort = labels_of_months(labels, months)
    cohort = staged_cohort(with_cutoff(cohort, lag_days, "anchor_expiry_date"))
    last = cohort.agg(F.max("feature_cutoff_date")).first()[0]
    if last is None:
        raise ValueError("no labeled rows for these months")
    last = as_int(last)
    threshold = stage(p99_secs(logs, cohort, last), "p99")
    rows = stage(
        labeled_features(cohort, txn, logs, members, threshold.scalar(), last), "features"
    )
    write_dataset(split_3way(rows, val_fraction, test_fraction, seed), threshold, root, version)
    write_histograms(labels.sparkSession, root, version, FEATURES)
    written = labels.sparkSession.read.parquet(f"{root}/rows")
    return split_summary(written.where(F.col("dataset_version_id") == version))
