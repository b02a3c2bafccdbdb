"""Daily scoring: cohort, features, score, tier, store, health, drift."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.dates import as_date, as_int
from stayline.operators.cohort import expiring_cohort
from stayline.operators.features import feature_matrix, with_cutoff
from stayline.operators.health import serving_health
from stayline.operators.pit import staged_cohort
from stayline.operators.tiers import DEFAULT_TIERS, Tier, with_risk_tier
from stayline.schemas import PREDICTION_STORE
from stayline.session import stage
from stayline.sources.writers import upsert_predictions

Scorer = Callable[[DataFrame], DataFrame]


def scored_cohort(
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    scoring_date: date | str,
    scorer: Scorer,
    p99: float | Column,
    model_version: str,
    lead_days: int = 14,
    lag_days: int = 14,
    tiers: tuple[Tier, ...] = DEFAULT_TIERS,
) -> DataFrame:
    """Features, score, tier and stamps of everyone expiring ``lead_days`` ahead.

    Everything stays in columns of one DataFrame from cohort to tier, so a score can never
    reach another user's row. All cutoffs are the same day, which also bounds the scans.
    """
    day = as_date(scoring_date)
    last_cutoff = as_int(day + timedelta(days=lead_days - lag_days))
    cohort = staged_cohort(with_cutoff(expiring_cohort(txn, day, lead_days), lag_days))
    features = feature_matrix(cohort, txn, logs, members, p99, last_cutoff)
    return with_risk_tier(scorer(features), tiers).withColumns(
        {"scoring_date": F.lit(day), "model_version": F.lit(model_version)}
    )


def prediction_rows(scored: DataFrame, created_at: datetime) -> DataFrame:
    """The scored cohort in the layout of the prediction store."""
    stamped = scored.withColumn("created_at", F.lit(created_at))
    return stamped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION_STORE.fields]
    )


def run_scoring(
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    scoring_date: date | str,
    scorer: Scorer,
    p99: float | Column,
    model_version: str,
    store: str,
    created_at: datetime,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Score a day into the store. Returns (scored with features, health metrics).

    The scored frame is staged once; store, health and a following drift check all read
    that copy instead of computing features again. A day without a cohort stores nothing.
    """
    scored = stage(
        scored_cohort(txn, logs, members, scoring_date, scorer, p99, model_version, **options), "scored-day"
    )
    written = upsert_predictions(prediction_rows(scored, created_at), store, staged=True)
    return scored, serving_health(scored, written)
