"""Reads of the prediction store."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, functions as F

from stayline.functions.dates import as_date, month_bounds
from stayline.operators.checks import USER_ID_PATTERN

_DETAILS = ["score", "risk_tier", "expiry_date", "model_version"]


def latest_prediction(predictions: DataFrame, user: str | None = None) -> DataFrame:
    """Each user's most recent prediction, or the one user's (no row when unknown)."""
    if user is not None:
        if not re.fullmatch(USER_ID_PATTERN, user):
            raise ValueError(f"not a user id: {user!r}")
        predictions = predictions.where(F.col("msno") == user)
    columns = [c for c in predictions.columns if c not in ("msno", "scoring_date")]
    latest = F.max(F.struct("scoring_date", *columns)).alias("_last")
    return predictions.groupBy("msno").agg(latest).select("msno", "_last.*")


def cohort_for_date(predictions: DataFrame, scoring_date: date | str) -> DataFrame:
    """All predictions of a scoring date, highest score first, with their number."""
    day = predictions.where(F.col("scoring_date") == F.lit(as_date(scoring_date)))
    total = day.agg(F.count(F.lit(1))).scalar()
    return day.select("msno", *_DETAILS, total.alias("count")).orderBy(F.desc("score"), "msno")


def scored_users(predictions: DataFrame, scoring_date: date | str) -> DataFrame:
    """The cohort scored on a date: (msno, expiry_date)."""
    return predictions.where(F.col("scoring_date") == F.lit(as_date(scoring_date))).select("msno", "expiry_date")


def predictions_for_month(predictions: DataFrame, month: str) -> DataFrame:
    """(msno, score, expiry_date) of one expiry month, as a range that scans can skip by."""
    first, last = (F.lit(as_date(f"{v // 10000:04d}-{v // 100 % 100:02d}-{v % 100:02d}")) for v in month_bounds(month))
    return predictions.where(F.col("expiry_date").between(first, last)).select("msno", "score", "expiry_date")


def bad_user_ids(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("msno").rlike(USER_ID_PATTERN), F.lit(False)))
