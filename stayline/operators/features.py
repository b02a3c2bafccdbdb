"""Leakage-safe features: everything known about a user on their cutoff day.

Rows are keyed by (msno, feature_cutoff_date), so a user in two cohorts gets two histories.
A user without rows in a source has NULL features, never 0.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.dates import int_to_date, month_of
from stayline.functions.numbers import (
    UNIT, exact_mean, exact_parts, exact_total, flag, part_names, ratio, round_half_away, summed_parts, total_plays,
)
from stayline.operators.cohort import valid_transactions
from stayline.operators.pit import in_intervals, known_at_cutoffs, running_totals, times_counted
from stayline.operators.running import quantile_row
from stayline.schemas import (
    FEATURES, LOG_FEATURES, MEMBER_FEATURES, PLAY_COUNTERS, TXN_FEATURES, require_columns,
)
from stayline.session import stage

KEY = ["msno", "feature_cutoff_date"]

# Seconds in a day, and the first plausible registration day.
DAY_SECS = 86400
FIRST_REGISTRATION = date(2000, 1, 1)


def with_cutoff(cohort: DataFrame, lag_days: int = 14, expiry: str = "expiry_date") -> DataFrame:
    """Derive the cutoff inside the engine; callers only ever pass an expiry date."""
    return cohort.withColumn("feature_cutoff_date", F.date_sub(F.col(expiry).cast("date"), lag_days))


def is_legacy() -> Column:
    """A payment booked without plan data: zero plan, zero list price, money paid."""
    return (
        (F.col("payment_plan_days") == 0)
        & (F.col("plan_list_price") == 0)
        & (F.col("actual_amount_paid") > 0)
    )


def winsorized_secs(p99_secs: float | Column, null_secs: str = "cap") -> Column:
    """Listening seconds capped at one day and at the threshold.

    ``least`` skips NULL, so a row without seconds counts as the threshold; pass
    ``null_secs='keep'`` to leave it NULL.
    """
    if null_secs not in ("cap", "keep"):
        raise ValueError(f"null_secs must be 'cap' or 'keep', got {null_secs!r}")
    p99 = F.lit(float(p99_secs)) if isinstance(p99_secs, (int, float)) else p99_secs
    secs = F.col("total_secs").cast("double")
    capped = F.least(secs, F.lit(float(DAY_SECS)), p99)
    return capped if null_secs == "cap" else F.when(secs.isNotNull(), capped)


def until(facts: DataFrame, column: str, last_cutoff: int | None) -> DataFrame:
    """Optional scan bound: no cohort cutoff is later than this YYYYMMDD integer."""
    return facts if last_cutoff is None else facts.where(F.col(column) <= last_cutoff)


TXN_SUMS, TXN_LARGEST = ["n_txn", "n_cancel"], ["ever_cancelled", "ever_promo", "_last"]
LOG_SUMS = ["log_days", *part_names("secs"), *part_names("completion"), "unq", "unq_n"]


def _txn_days(txn: DataFrame, drop_backdated: bool, last_cutoff: int | None) -> DataFrame:
    """Payments per user and day, with the day's last one."""
    rows = until(valid_transactions(txn, drop_backdated), "transaction_date", last_cutoff)
    return (
        rows.groupBy("msno", "transaction_date")
        .agg(
            F.count(F.lit(1)).alias("n_txn"),
            F.sum("is_cancel").alias("n_cancel"),
            F.max(F.col("is_cancel").cast("int")).alias("ever_cancelled"),
            F.max(flag(F.col("actual_amount_paid") == 0)).alias("ever_promo"),
            F.max(
                F.struct(
                    "membership_expire_date", "actual_amount_paid", "payment_plan_days", "plan_list_price",
                    "is_auto_renew", "is_cancel",
                )
            ).alias("_row"),
        )
        .withColumn("txn_dt", int_to_date("transaction_date"))
        .drop("transaction_date")
    )


def _txn_columns() -> list[Column]:
    """The transaction features of the sums and the last row up to a cutoff."""
    priced = ~F.coalesce(is_legacy(), F.lit(False))
    return [
        F.col("n_txn"),
        F.col("n_cancel"),
        F.col("ever_cancelled"),
        F.col("ever_promo"),
        F.col("is_auto_renew").cast("int").alias("last_is_auto_renew"),
        F.col("is_cancel").cast("int").alias("last_is_cancel"),
        F.when(priced, F.col("actual_amount_paid")).alias("last_actual_amount_paid"),
        F.when(priced, F.col("payment_plan_days").cast("int")).alias("last_payment_plan_days"),
        F.when(priced, F.col("plan_list_price")).alias("last_plan_list_price"),
        F.when(priced, F.col("plan_list_price") - F.col("actual_amount_paid")).alias("last_discount"),
        round_half_away(ratio(F.col("n_cancel"), F.col("n_txn")), 4).alias("cancel_rate"),
        F.date_diff("feature_cutoff_date", "txn_dt").alias("days_since_last_txn"),
    ]


def txn_features(
    txn: DataFrame,
    cohort: DataFrame,
    drop_backdated: bool = True,
    last_cutoff: int | None = None,
    hint: str | None = None,
) -> DataFrame:
    """The transaction features: per user and day, per interval between cutoffs, then merged up to each cutoff.

    The latest row's attributes come from a maximum over a struct that starts with the
    payment day. The remaining fields break ties in a fixed order, so that same-day
    transactions always give the same answer.
    """
    daily = _txn_days(txn, drop_backdated, last_cutoff)
    intervals = in_intervals(daily, cohort, "txn_dt", hint).groupBy(*KEY).agg(
        F.sum("n_txn").alias("n_txn"),
        F.sum("n_cancel").alias("n_cancel"),
        F.max("ever_cancelled").alias("ever_cancelled"),
        F.max("ever_promo").alias("ever_promo"),
        F.max(F.struct("txn_dt", "_row")).alias("_last"),
    )
    agg = running_totals(intervals, TXN_SUMS, TXN_LARGEST)
    flat = agg.select(*KEY, "n_txn", "n_cancel", "ever_cancelled", "ever_promo", "_last.txn_dt", "_last._row.*")
    return flat.select(*KEY, *_txn_columns())


def _log_days(logs: DataFrame, p99_secs: float | Column, null_secs: str, last_cutoff: int | None) -> DataFrame:
    """Usage per user and day, in sums that are exact in any order of rows."""
    plays = total_plays(PLAY_COUNTERS)
    return (
        until(logs, "date", last_cutoff)
        .groupBy("msno", "date")
        .agg(
            F.count(F.lit(1)).alias("log_days"),
            *exact_parts(winsorized_secs(p99_secs, null_secs), "secs"),
            *exact_parts(ratio(F.col("num_100"), plays), "completion", UNIT),
            F.sum(F.col("num_unq").cast("bigint")).alias("unq"),
            F.count("num_unq").alias("unq_n"),
        )
        .withColumn("log_dt", int_to_date("date"))
        .drop("date")
    )


def _log_columns() -> list[Column]:
    """The usage features of the sums up to a cutoff."""
    return [
        F.col("log_days"),
        round_half_away(exact_mean("secs"), 1).alias("avg_daily_secs"),
        round_half_away(exact_total("secs"), 0).alias("total_secs_sum"),
        round_half_away(exact_mean("completion", UNIT), 4).alias("avg_completion_ratio"),
        round_half_away(ratio(F.col("unq"), F.col("unq_n")), 2).alias("avg_daily_unq_songs"),
        F.date_diff("feature_cutoff_date", "_last").alias("days_since_last_log"),
    ]


def log_features(
    logs: DataFrame,
    cohort: DataFrame,
    p99_secs: float | Column,
    null_secs: str = "cap",
    last_cutoff: int | None = None,
    hint: str | None = None,
) -> DataFrame:
    """The usage features, from fixed-size sums that are exact in any order of rows: per day, per interval, merged."""
    daily = _log_days(logs, p99_secs, null_secs, last_cutoff)
    intervals = in_intervals(daily, cohort, "log_dt", hint).groupBy(*KEY).agg(
        F.sum("log_days").alias("log_days"),
        *summed_parts("secs"),
        *summed_parts("completion"),
        F.sum("unq").alias("unq"),
        F.sum("unq_n").alias("unq_n"),
        F.max("log_dt").alias("_last"),
    )
    agg = running_totals(intervals, LOG_SUMS, ["_last"])
    return agg.select(*KEY, *_log_columns())


def with_member_features(cohort: DataFrame, members: DataFrame) -> DataFrame:
    """Every cohort row plus channel and tenure, NULL unless registration is plausible.

    The plausibility window sits in the join condition, so one left join is enough.
    """
    m = members.select(
        F.col("msno").alias("_msno"),
        F.col("registered_via").cast("int").alias("registered_via"),
        int_to_date("registration_init_time").alias("_registered"),
    )
    on = (F.col("msno") == F.col("_msno")) & F.col("_registered").between(
        F.lit(FIRST_REGISTRATION), F.col("feature_cutoff_date")
    )
    return (
        cohort.join(m, on, "left")
        .withColumn("tenure_days", F.date_diff("feature_cutoff_date", "_registered"))
        .drop("_msno", "_registered")
    )


def member_features(members: DataFrame, cohort: DataFrame) -> DataFrame:
    """Only the cohort rows that have a usable member record."""
    joined = with_member_features(cohort.select(*KEY), members)
    return joined.where("tenure_days IS NOT NULL").select(*KEY, *MEMBER_FEATURES)


def feature_matrix(
    cohort: DataFrame,
    txn: DataFrame,
    logs: DataFrame,
    members: DataFrame,
    p99_secs: float | Column,
    last_cutoff: int | None = None,
    null_secs: str = "cap",
    most_users: bool = False,
) -> DataFrame:
    """All features for every cohort row; other cohort columns are kept in front.

    Training, scoring and drift all call this, so they cannot disagree. A stored cohort
    (``pit.staged_cohort``) has a size that Spark can plan with. For a cohort of ``most_users``
    both kinds of facts meet its rows in one shuffle, with equal results; else joins drop the
    facts of other users first.
    """
    require_columns(cohort, KEY, "cohort")
    if most_users:
        return _features_in_one_pass(cohort, txn, logs, members, p99_secs, last_cutoff, null_secs)
    out = (
        with_member_features(cohort, members)
        .join(txn_features(txn, cohort, last_cutoff=last_cutoff), KEY, "left")
        .join(log_features(logs, cohort, p99_secs, null_secs, last_cutoff), KEY, "left")
    )
    return out.select(*cohort.columns, *FEATURES)


def _features_in_one_pass(
    cohort: DataFrame, txn: DataFrame, logs: DataFrame, members: DataFrame, p99_secs: float | Column, last_cutoff: int | None, null_secs: str
) -> DataFrame:
    paid = _txn_days(txn, True, last_cutoff).withColumn("_last", F.struct("txn_dt", "_row"))
    used = _log_days(logs, p99_secs, null_secs, last_cutoff).withColumn("_last", F.col("log_dt"))
    known = known_at_cutoffs(
        with_member_features(cohort, members),
        {"_txn": (paid, "txn_dt", TXN_SUMS, TXN_LARGEST), "_logs": (used, "log_dt", LOG_SUMS, ["_last"])},
    )
    # One after the other, as parts of both have equal names.
    of_txn = known.select(
        "_row", "_logs", "_row.feature_cutoff_date", *[f"_txn.{c}" for c in TXN_SUMS + TXN_LARGEST[:-1]], "_txn._last.txn_dt", "_txn._last._row.*"
    ).select("_row", "_logs", "feature_cutoff_date", F.struct(*_txn_columns()).alias("_txn"))
    of_both = of_txn.select("_row", "_txn", "feature_cutoff_date", "_logs.*").select("_row", "_txn", F.struct(*_log_columns()).alias("_logs"))
    groups = [("_row", cohort.columns), ("_txn", TXN_FEATURES), ("_logs", LOG_FEATURES), ("_row", MEMBER_FEATURES)]
    return of_both.select(*[F.col(f"{group}.`{c}`") for group, names in groups for c in names])


def p99_secs(logs: DataFrame, cohort: DataFrame | None = None, last_cutoff: int | None = None) -> DataFrame:
    """One row ``p99_secs``: the 99th percentile of seconds capped at a day.

    With a cohort a log counts once for each of its user's cutoffs that it precedes, by its
    weight and without copies; one day's worth of seconds is the answer when there are none.
    Without a cohort all logs count once. Almost every value is different, so a scan for
    brackets comes first.
    """
    # ``least`` skips NULL: a row without seconds counts as a full day.
    capped = F.least(F.col("total_secs").cast("double"), F.lit(float(DAY_SECS))).alias("secs")
    rows = until(logs, "date", last_cutoff).select("msno", int_to_date("date").alias("log_dt"), capped)
    weight = None
    if cohort is not None:
        # Stored, because both scans would else build and join the logs again.
        rows, weight = stage(times_counted(rows, cohort, "log_dt", "times").select("secs", "times"), "weighted-secs"), "times"
    return quantile_row(rows, "secs", {"p99_secs": 0.99}, continuous=True, weight=weight).select(
        F.coalesce("p99_secs", F.lit(float(DAY_SECS))).alias("p99_secs")
    )


def training_rows(features: DataFrame) -> DataFrame:
    """Labeled features in training layout: key, features, label, month, log availability.

    ``features`` carries ``is_churn`` and ``anchor_expiry_date``, which ``feature_matrix``
    passes through from its cohort.
    """
    return features.select(
        *KEY,
        *FEATURES,
        "is_churn",
        month_of("anchor_expiry_date").alias("cohort_month"),
        F.col("log_days").isNotNull().cast("tinyint").alias("has_log_data"),
    )


def attach_labels(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Training layout for features and labels that were computed apart: a left join by key."""
    meta = labels.select(*KEY, "anchor_expiry_date", "is_churn")
    return training_rows(meta.join(features.select(*KEY, *FEATURES), KEY, "left"))


def null_rates(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Share of NULLs per feature and its group, in one pass."""
    columns = columns or FEATURES
    by = by or []
    rates = df.groupBy(*by).agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    group = F.when(F.col("feature").isin(TXN_FEATURES), "transaction")
    group = group.when(F.col("feature").isin(LOG_FEATURES), "usage").otherwise("member")
    return rates.unpivot(by, columns, "feature", "null_rate").withColumn("feature_group", group)
