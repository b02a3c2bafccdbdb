"""Monthly labels: cohort, renewals, store, health."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from stayline.operators.health import labeling_health
from stayline.operators.labels import month_labels
from stayline.session import stage
from stayline.sources.writers import upsert_labels


def run_labeling(
    txn: DataFrame,
    month: str,
    labeled_date: date | str,
    store: str,
    window_days: int = 30,
    lag_days: int = 14,
) -> DataFrame:
    """Label one cohort month, merge into the label store, return health metrics.

    An empty month writes nothing and reports a cohort size of 0.
    """
    labels = stage(month_labels(txn, month, labeled_date, window_days, lag_days), "labels")
    written = upsert_labels(labels, store, staged=True)
    return labeling_health(labels, written)
