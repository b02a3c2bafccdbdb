import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayline.operators import cohort, labels

D = dt.date


@pytest.fixture(scope="module")
def txn(make):
    return make.txn(
        [
            ("a", 20170201, 20170303, 0), ("a", 20170303, 20170402, 0),
            ("b", 20170205, 20170305, 0), ("b", 20170306, 20170405, 0),
            ("c", 20170205, 20170305, 0), ("c", 20170404, 20170504, 0),
            ("d", 20170205, 20170305, 0), ("d", 20170405, 20170505, 0),
            ("e", 20170205, 20170305, 0), ("e", 20170310, 20170409, 1),
            ("f", 20170305, 20170303, 0),
            ("g", 20170101, 20170301, 0), ("g", 20170201, 20170331, 0),
            ("h", 20170101, 20170310, 0), ("h", 20170301, 20170510, 0),
            ("i", 20170101, 20170228, 0),
        ]
    )


EXPECTED = {
    "a": (D(2017, 3, 3), 1),   # a payment on the anchor day itself is no renewal
    "b": (D(2017, 3, 5), 0),
    "c": (D(2017, 3, 5), 0),   # day 30 counts
    "d": (D(2017, 3, 5), 1),   # day 31 does not
    "e": (D(2017, 3, 5), 1),   # a cancellation does not renew
    "g": (D(2017, 3, 31), 1),  # latest expiry inside the month
    "h": (D(2017, 3, 10), 1),  # a later expiry outside the month does not matter
}


def as_dict(df):
    return {r.msno: (r.anchor_expiry_date, r.is_churn) for r in df.collect()}


def test_join_form(txn):
    c = cohort.label_cohort(txn, "2017-03")
    assert as_dict(labels.churn_labels(c, txn, "2017-05-01")) == EXPECTED


def test_single_scan_form(txn):
    got = labels.month_labels(txn, "2017-03", "2017-05-01")
    assert got.columns == ["msno", "anchor_expiry_date", "feature_cutoff_date", "is_churn", "labeled_date"]
    assert as_dict(got) == EXPECTED
    row = got.where("msno = 'b'").first()
    assert row.feature_cutoff_date == D(2017, 2, 19) and row.labeled_date == D(2017, 5, 1)


@pytest.mark.parametrize("window", [1, 7, 30, 31, 32, 60])
def test_both_forms_agree(txn, window):
    c = cohort.label_cohort(txn, "2017-03")
    joined = labels.churn_labels(c, txn, "2017-05-01", window)
    assert as_dict(labels.month_labels(txn, "2017-03", "2017-05-01", window)) == as_dict(joined)


def test_backdated_rows(txn):
    kept = cohort.label_cohort(txn, "2017-03", drop_backdated=False)
    assert {r.msno for r in kept.collect()} == set(EXPECTED) | {"f"}


def test_month_bounds_prune_without_changing_labels(txn):
    c = cohort.label_cohort(txn, "2017-03")
    bounds = labels.window_bounds("2017-03", "2017-03")
    assert bounds == (20170302, 20170430)
    assert as_dict(labels.churn_labels(c, txn, "2017-05-01", bounds=bounds)) == EXPECTED


def test_several_months_in_one_pass(txn):
    several = cohort.monthly_cohorts(txn, "2017-03", "2017-05")
    for month in ("2017-03", "2017-04", "2017-05"):
        one = {(r.msno, r.anchor_expiry_date) for r in cohort.label_cohort(txn, month).collect()}
        part = several.where(F.date_format("anchor_expiry_date", "yyyy-MM") == month)
        assert {(r.msno, r.anchor_expiry_date) for r in part.collect()} == one


def test_renewed_users_and_empty_cohort(txn):
    c = cohort.label_cohort(txn, "2017-03")
    assert {r.msno for r in labels.renewed_users(c, txn).collect()} == {"b", "c"}
    empty = labels.month_labels(txn, "2030-01", "2030-03-01")
    assert empty.count() == 0 and empty.columns[0] == "msno"


def test_next_renewals_equal_a_search(spark, make):
    import random

    rng = random.Random(3)
    day = lambda: 20170100 + 100 * rng.randrange(6) + 1 + rng.randrange(28)
    rows = [(f"u{rng.randrange(9)}", day(), 20180101, rng.randrange(2)) for _ in range(300)]
    as_day = lambda v: D(v // 10000, v // 100 % 100, v % 100)
    anchors = [(u, as_day(day()), k) for k, u in enumerate([f"u{i % 10}" for i in range(60)] + [None])] + [("u1", None, 99)]
    c = spark.createDataFrame(anchors, "msno string, anchor_expiry_date date, k int")
    txn = make.txn(rows)
    got = {r.k: r.next_renewal for r in labels.next_renewals(c, txn).collect()}
    paid = [(u, as_day(d)) for u, d, _, cancel in rows if not cancel]
    assert got == {k: min((d for v, d in paid if v == u and a and d > a), default=None) for u, a, k in anchors}


def test_expiring_cohort(txn):
    got = cohort.expiring_cohort(txn, "2017-02-19").collect()
    assert {(r.msno, r.expiry_date) for r in got} == {(u, D(2017, 3, 5)) for u in "bcde"}


def test_rates(txn):
    all_labels = labels.month_labels(txn, "2017-03", "2017-05-01")
    row = labels.churn_rate(all_labels).first()
    assert (row.total, row.churned, row.retained, row.churn_rate_pct) == (7, 5, 2, 71.4286)
    ratio = labels.class_ratio(all_labels).first()
    assert ratio.scale_pos_weight == pytest.approx(0.4)
    assert labels.class_ratio(all_labels.where("is_churn = 0")).first().scale_pos_weight == 2.0


def test_labels_for_months(txn):
    stored = labels.churn_labels(cohort.monthly_cohorts(txn, "2017-02", "2017-05"), txn, "2017-06-01")
    months = {r.anchor_expiry_date.month for r in labels.labels_for_months(stored, ["2017-03", "2017-05"]).collect()}
    assert months == {3, 5}
    assert labels.labels_for_months(stored).count() == stored.count()


@pytest.mark.parametrize("bad", [dict(window_days=0), dict(window_days=-1)])
def test_argument_checks(txn, bad):
    with pytest.raises(ValueError):
        labels.with_renewal(cohort.label_cohort(txn, "2017-03"), txn, **bad)
    with pytest.raises(ValueError):
        labels.month_labels(txn, "2017-03", "2017-05-01", **bad)
    for call in (
        lambda: cohort.label_cohort(txn, "2017-13"),
        lambda: cohort.label_cohort(txn, "2017-03", lag_days=0),
        lambda: cohort.monthly_cohorts(txn, "2017-03", "2017-04", lag_days=-1),
        lambda: labels.labels_for_months(txn, ["2017-3"]),
    ):
        with pytest.raises(ValueError):
            call()


def test_latest_transaction_forms_agree(txn):
    a = {tuple(sorted(r.asDict().items())) for r in cohort.latest_transaction(txn).collect()}
    b = {tuple(sorted(r.asDict().items())) for r in cohort.latest_transaction_window(txn).collect()}
    assert a == b and len(a) == 9
