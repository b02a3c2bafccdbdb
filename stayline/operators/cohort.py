"""Who expires when."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.functions.dates import as_date, as_int, check_days, int_prefix, int_to_date, month_bounds


def valid_transactions(txn: DataFrame, drop_backdated: bool = True) -> DataFrame:
    """Drop rows whose expiry lies before the payment (YYYYMMDD integers order like dates)."""
    if not drop_backdated:
        return txn
    return txn.where(F.col("membership_expire_date") >= F.col("transaction_date"))


def anchored_cohort(
    txn: DataFrame,
    first: int,
    last: int,
    lag_days: int = 14,
    drop_backdated: bool = True,
) -> DataFrame:
    """Latest expiry per user inside [first, last], with its feature cutoff.

    Later expiries outside the range do not matter. The range filter is on the raw integer,
    so it reaches the Parquet reader; the date is parsed once per user, after the aggregate.
    """
    check_days(lag_days=lag_days)
    return (
        valid_transactions(txn, drop_backdated)
        .where(F.col("membership_expire_date").between(first, last))
        .groupBy("msno")
        .agg(F.max("membership_expire_date").alias("_expire"))
        .select("msno", int_to_date("_expire").alias("anchor_expiry_date"))
        .withColumn("feature_cutoff_date", F.date_sub("anchor_expiry_date", lag_days))
    )


def label_cohort(txn: DataFrame, month: str, lag_days: int = 14, drop_backdated: bool = True) -> DataFrame:
    """The cohort of one 'YYYY-MM' month."""
    return anchored_cohort(txn, *month_bounds(month), lag_days, drop_backdated)


def monthly_cohorts(
    txn: DataFrame,
    first_month: str,
    last_month: str,
    lag_days: int = 14,
    drop_backdated: bool = True,
) -> DataFrame:
    """The cohorts of several months in one pass: one row per user and month of expiry."""
    check_days(lag_days=lag_days)
    first, last = month_bounds(first_month)[0], month_bounds(last_month)[1]
    return (
        valid_transactions(txn, drop_backdated)
        .where(F.col("membership_expire_date").between(first, last))
        .groupBy("msno", F.floor(F.col("membership_expire_date") / 100).alias("_month"))
        .agg(F.max("membership_expire_date").alias("_expire"))
        .select("msno", int_to_date("_expire").alias("anchor_expiry_date"))
        .withColumn("feature_cutoff_date", F.date_sub("anchor_expiry_date", lag_days))
    )


def expiring_cohort(txn: DataFrame, scoring_date: date | str, lead_days: int = 14) -> DataFrame:
    """Users whose membership expires exactly ``lead_days`` after the scoring date."""
    target = as_date(scoring_date) + timedelta(days=lead_days)
    return (
        valid_transactions(txn)
        .where(F.col("membership_expire_date") == as_int(target))
        .select("msno")
        .distinct()
        .withColumn("expiry_date", F.lit(target))
    )


def labeled_anchors(train: DataFrame, txn: DataFrame, first: int, last: int, lag_days: int = 14) -> DataFrame:
    """Official labels anchored on the user's latest expiry in the range.

    Backdated rows count here, and users without such an expiry are dropped. Expiries are
    reduced to one row per user before the join.
    """
    latest = (
        txn.where(F.col("membership_expire_date").between(first, last))
        .groupBy("msno")
        .agg(F.max("membership_expire_date").alias("_expire"))
    )
    return (
        train.select("msno", "is_churn")
        .distinct()
        .join(latest, "msno")
        .select("msno", "is_churn", int_to_date("_expire").alias("anchor_expiry_date"))
        .withColumn("feature_cutoff_date", F.date_sub("anchor_expiry_date", lag_days))
    )


def latest_transaction(txn: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Each user's single latest transaction row, by payment date, then expiry.

    Written as a maximum over a struct rather than a window: every map task then sends one
    row per user, however many rows a user has. Remaining columns break ties.
    """
    order = ["transaction_date", "membership_expire_date"]
    order += [c for c in txn.columns if c not in order and c != "msno"]
    rows = txn if users is None else txn.join(users.select("msno").distinct(), "msno", "left_semi")
    return rows.groupBy("msno").agg(F.max(F.struct(*order)).alias("_last")).select("msno", "_last.*")


def latest_transaction_window(txn: DataFrame) -> DataFrame:
    """The same result by ``row_number``; kept as the cross-check of the aggregate form."""
    order = ["transaction_date", "membership_expire_date"]
    order += [c for c in txn.columns if c not in order and c != "msno"]
    w = Window.partitionBy("msno").orderBy(*[F.desc(c) for c in order])
    return txn.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def expiry_bucket(column: str, anchor_month: str, later_months: list[str]) -> Column:
    """Label an expiry: in the anchor month, in one of the later months, or other."""
    first, last = month_bounds(anchor_month)
    out = F.when(F.col(column).between(first, last), F.lit(f"anchor:{anchor_month}"))
    for month in later_months:
        out = out.when(int_prefix(column, 6) == month.replace("-", ""), F.lit(f"later:{month}"))
    return out.otherwise(F.lit("elsewhere"))
