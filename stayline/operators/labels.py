"""Churn labels from renewals."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.functions.dates import as_date, check_days, int_to_date, month_bounds, month_of, shift_int
from stayline.functions.numbers import flag, percent, ratio
from stayline.operators.cohort import valid_transactions
from stayline.schemas import LABEL_COLUMNS


def next_renewals(
    cohort: DataFrame,
    txn: DataFrame,
    bounds: tuple[int, int] | None = None,
    drop_backdated: bool = True,
) -> DataFrame:
    """The cohort plus ``next_renewal``: the first day after the anchor on which the user paid for more, or NULL.

    Anchors and payments meet in one shuffle by user, in which payments are combined to a
    set of days on the map side, so a user with any number of payments brings no more
    days than the calendar has. Each anchor then takes the first of its user's days after it,
    without a sort of both. ``bounds`` are YYYYMMDD integers and prune the scan.
    """
    paid = valid_transactions(txn, drop_backdated).where((F.col("is_cancel") == 0) & F.col("msno").isNotNull())
    if bounds:
        paid = paid.where(F.col("transaction_date").between(*bounds))
    others = [c for c in cohort.columns if c != "msno"]
    anchors = cohort.select("msno", F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"))
    paid = paid.select("msno", F.lit(None).cast(anchors.schema["_row"].dataType).alias("_row"), int_to_date("transaction_date").alias("_paid"))
    both = anchors.withColumn("_paid", F.lit(None).cast("date")).unionByName(paid)
    users = both.groupBy("msno").agg(F.collect_list("_row").alias("_rows"), F.collect_set("_paid").alias("_days")).where(F.size("_rows") > 0)
    read = users.select("msno", "_days", F.explode("_rows").alias("_row"))
    later = F.array_min(F.filter("_days", lambda d: d > F.col("_row.anchor_expiry_date")))
    return read.select(*["msno" if c == "msno" else F.col(f"_row.`{c}`") for c in cohort.columns], later.alias("next_renewal"))


def with_renewal(
    cohort: DataFrame,
    txn: DataFrame,
    window_days: int = 30,
    bounds: tuple[int, int] | None = None,
    drop_backdated: bool = True,
) -> DataFrame:
    """The cohort plus ``renewed``: a renewal in (anchor, anchor + window_days]."""
    check_days(window_days=window_days)
    inside = F.col("next_renewal") <= F.date_add("anchor_expiry_date", window_days)
    found = next_renewals(cohort, txn, bounds, drop_backdated)
    return found.withColumn("renewed", F.coalesce(inside, F.lit(False))).drop("next_renewal")


def renewed_users(
    cohort: DataFrame,
    txn: DataFrame,
    window_days: int = 30,
    bounds: tuple[int, int] | None = None,
    drop_backdated: bool = True,
) -> DataFrame:
    """Distinct users of the cohort who renewed inside their window."""
    return with_renewal(cohort, txn, window_days, bounds, drop_backdated).where("renewed").select("msno").distinct()


def churn_labels(
    cohort: DataFrame,
    txn: DataFrame,
    labeled_date: date | str,
    window_days: int = 30,
    bounds: tuple[int, int] | None = None,
    drop_backdated: bool = True,
) -> DataFrame:
    """is_churn = 0 for a user who renewed in the window after the anchor, else 1."""
    renewed = with_renewal(cohort, txn, window_days, bounds, drop_backdated)
    return renewed.select(
        "msno",
        "anchor_expiry_date",
        "feature_cutoff_date",
        flag(~F.col("renewed")).cast("short").alias("is_churn"),
        F.lit(as_date(labeled_date)).alias("labeled_date"),
    ).select(*LABEL_COLUMNS)


def window_bounds(first_month: str, last_month: str, window_days: int = 30) -> tuple[int, int]:
    """Scan bounds that hold every renewal of the cohorts of these months."""
    first, last = month_bounds(first_month)[0], month_bounds(last_month)[1]
    return shift_int(first, 1), shift_int(last, window_days)


def month_labels(
    txn: DataFrame,
    month: str,
    labeled_date: date | str,
    window_days: int = 30,
    lag_days: int = 14,
    drop_backdated: bool = True,
) -> DataFrame:
    """Cohort and labels of one month from a single scan and a single shuffle.

    Per user only two things matter: the latest expiry in the month, and on which days of
    (first of month, end of month + window] a renewal was paid. The days are the bits of a
    few longs, so all are plain fixed-size aggregates: map tasks combine them, there is no
    join, and a user with a third of all rows is one row per task.
    """
    check_days(window_days=window_days, lag_days=lag_days)
    first, last = month_bounds(month)
    lo, hi = shift_int(first, 1), shift_int(last, window_days)
    expires = F.col("membership_expire_date").between(first, last)
    renews = (F.col("is_cancel") == 0) & F.col("transaction_date").between(lo, hi)
    start = F.lit(as_date(f"{month}-01"))
    # Day i after the first of the month is bit i % 62 of word i // 62.
    words = range((31 + window_days) // 62 + 1)
    paid_day = F.date_diff(int_to_date("transaction_date"), start)
    anchor_day = F.date_diff("anchor_expiry_date", start)

    def ones(n: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), n) - 1

    def paid(word: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), paid_day - 62 * word)
        return F.bit_or(F.when(renews & paid_day.between(62 * word, 62 * word + 61), bit)).alias(f"_paid{word}")

    def in_window(word: int) -> Column:
        """Renewals of the word's days in (anchor, anchor + window_days]."""
        low = F.least(F.greatest(anchor_day + 1 - 62 * word, F.lit(0)), F.lit(62))
        high = F.greatest(F.least(anchor_day + window_days + 1 - 62 * word, F.lit(62)), F.lit(0))
        mask = F.when(high > low, ones(high) - ones(low)).otherwise(F.lit(0).cast("bigint"))
        return F.coalesce(F.col(f"_paid{word}"), F.lit(0).cast("bigint")).bitwiseAND(mask) != 0

    return (
        valid_transactions(txn, drop_backdated)
        .where(expires | renews)
        .groupBy("msno")
        .agg(F.max(F.when(expires, F.col("membership_expire_date"))).alias("_expire"), *[paid(w) for w in words])
        .where(F.col("_expire").isNotNull())
        .withColumn("anchor_expiry_date", int_to_date("_expire"))
        .select(
            "msno",
            "anchor_expiry_date",
            F.date_sub("anchor_expiry_date", lag_days).alias("feature_cutoff_date"),
            flag(~reduce(or_, [in_window(w) for w in words])).cast("short").alias("is_churn"),
            F.lit(as_date(labeled_date)).alias("labeled_date"),
        )
    )


def labels_of_months(labels: DataFrame, months: list[str] | None = None) -> DataFrame:
    """Stored labels of the given 'YYYY-MM' months (all when empty), in no order.

    The months become a range on the anchor date as well, so files and row groups outside
    it are skipped.
    """
    out = labels
    if months:
        bounds = [month_bounds(m) for m in months]
        lo, hi = min(b[0] for b in bounds), max(b[1] for b in bounds)
        lo, hi = (date(v // 10000, v // 100 % 100, v % 100) for v in (lo, hi))
        out = out.where(F.col("anchor_expiry_date").between(F.lit(lo), F.lit(hi)))
        out = out.where(month_of("anchor_expiry_date").isin(months))
    return out.select("msno", "anchor_expiry_date", "is_churn")


def labels_for_months(labels: DataFrame, months: list[str] | None = None) -> DataFrame:
    """:func:`labels_of_months` by anchor date, for readers."""
    return labels_of_months(labels, months).orderBy("anchor_expiry_date", "msno")


def churn_rate(labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """total, churned, retained and the churn rate, overall or per group."""
    n, churned = F.count(F.lit(1)), F.coalesce(F.sum("is_churn"), F.lit(0).cast("bigint"))
    return labels.groupBy(*(by or [])).agg(
        n.alias("total"),
        churned.alias("churned"),
        (n - churned).alias("retained"),
        percent(churned, n, 4).alias("churn_rate_pct"),
    )


def class_ratio(labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Retained over churned, with a divisor of at least 1: the positive-class weight."""
    neg, pos = F.count_if(F.col("is_churn") == 0), F.count_if(F.col("is_churn") == 1)
    return labels.groupBy(*(by or [])).agg(
        neg.alias("n_negative"),
        pos.alias("n_positive"),
        ratio(neg, F.greatest(pos, F.lit(1).cast("bigint"))).alias("scale_pos_weight"),
    )
