import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayline.operators import features
from stayline.schemas import FEATURES

D = dt.date
CUTOFF = D(2017, 3, 15)


@pytest.fixture(scope="module")
def one_cohort(spark):
    def build(*users, cutoff=CUTOFF):
        return spark.createDataFrame([(u, cutoff) for u in users], "msno string, feature_cutoff_date date")

    return build


def by_user(df):
    return {r.msno: r.asDict() for r in df.collect()}


def test_cutoff_is_derived_from_expiry(spark):
    c = spark.createDataFrame([("a", "2017-03-29")], "msno string, expiry_date string")
    assert features.with_cutoff(c).first().feature_cutoff_date == CUTOFF


def test_txn_edges(make, one_cohort):
    txn = make.txn(
        [
            ("on", 20170315, 20170415, 0),
            ("after", 20170316, 20170415, 1),
            ("legacy", 20170101, 20170131, 0), ("legacy", 20170310, 20170409, 1, 0, 0, 149),
            ("pair", 20170310, 20170409, 0, 30, 149, 149), ("pair", 20170310, 20170409, 0, 90, 447, 149),
            ("promo", 20170301, 20170331, 1, 30, 149, 0), ("promo", 20170302, 20170401, 0, 30, 149, 99),
            ("backdated", 20170310, 20170308, 1),
        ]
    )
    got = by_user(features.txn_features(txn, one_cohort("on", "after", "legacy", "pair", "promo", "backdated")))
    assert set(got) == {"on", "legacy", "pair", "promo"}
    assert got["on"]["days_since_last_txn"] == 0 and got["on"]["n_txn"] == 1
    legacy = got["legacy"]
    assert legacy["n_txn"] == 2 and legacy["last_is_cancel"] == 1 and legacy["cancel_rate"] == 0.5
    for c in ("last_actual_amount_paid", "last_payment_plan_days", "last_plan_list_price", "last_discount"):
        assert legacy[c] is None
    assert got["pair"]["last_payment_plan_days"] == 90 and got["pair"]["last_discount"] == 298
    promo = got["promo"]
    assert (promo["ever_promo"], promo["ever_cancelled"], promo["last_discount"]) == (1, 1, 50)


def test_log_edges(make, one_cohort):
    logs = make.logs(
        [
            ("on", 20170315, 100.0), ("on", 20170316, 900.0),
            ("zero", 20170301, 50.0, 0, 0, 0, 0, 0, 0), ("zero", 20170302, 50.0, 1, 0, 0, 0, 3, 2),
            ("cap", 20170301, 100000.0), ("cap", 20170302, 50000.0),
            ("nosecs", 20170301, None),
        ]
    )
    c = one_cohort("on", "zero", "cap", "nosecs")
    got = by_user(features.log_features(logs, c, 43805.516))
    assert got["on"]["log_days"] == 1 and got["on"]["days_since_last_log"] == 0
    assert got["zero"]["log_days"] == 2 and got["zero"]["avg_completion_ratio"] == 0.75
    assert got["cap"]["avg_daily_secs"] == 43805.5 and got["cap"]["total_secs_sum"] == 87611.0
    assert got["nosecs"]["total_secs_sum"] == 43806.0
    kept = by_user(features.log_features(logs, c, 43805.516, null_secs="keep"))
    assert kept["nosecs"]["total_secs_sum"] is None and kept["nosecs"]["log_days"] == 1


def test_member_edges(make, one_cohort):
    members = make.members([("old", 19991231), ("first", 20000101), ("same", 20170315), ("late", 20170316)])
    c = one_cohort("old", "first", "same", "late", "none")
    got = by_user(features.with_member_features(c, members))
    assert got["old"]["registered_via"] is None and got["late"]["registered_via"] is None
    assert got["same"]["tenure_days"] == 0 and got["first"]["tenure_days"] == (CUTOFF - D(2000, 1, 1)).days
    assert got["none"]["tenure_days"] is None
    assert set(by_user(features.member_features(members, c))) == {"first", "same"}


def test_absence_is_null_and_columns_are_fixed(make, one_cohort):
    args = make.txn([("x", 20170301, 20170331, 0)]), make.logs([("x", 20170301, 1.0)]), make.members([("x", 20100101)])
    got = features.feature_matrix(one_cohort("ghost"), *args, 86400.0)
    assert got.columns == ["msno", "feature_cutoff_date", *FEATURES]
    row = got.first()
    assert all(row[c] is None for c in FEATURES)


def test_two_cohorts_keep_two_histories(spark, make):
    txn = make.txn([("u", 20170210, 20170312, 0), ("u", 20170310, 20170409, 1)])
    c = spark.createDataFrame(
        [("u", D(2017, 2, 15)), ("u", D(2017, 3, 15))], "msno string, feature_cutoff_date date"
    )
    got = {r.feature_cutoff_date: r.n_txn for r in features.txn_features(txn, c).collect()}
    assert got == {D(2017, 2, 15): 1, D(2017, 3, 15): 2}


def test_nothing_after_the_cutoff_changes_anything(make, one_cohort):
    txn = [("u", 20170301, 20170331, 0), ("v", 20170201, 20170303, 1)]
    logs = [("u", 20170303, 500.0), ("v", 20170304, 700.0)]
    c, m = one_cohort("u", "v"), make.members([("u", 20150101), ("v", 20160101)])
    before = by_user(features.feature_matrix(c, make.txn(txn), make.logs(logs), m, 86400.0))
    txn += [(u, 20170316, 20170415, 1, 90, 447, 0) for u in "uv"]
    logs += [(u, 20170320, 80000.0) for u in "uv"]
    assert by_user(features.feature_matrix(c, make.txn(txn), make.logs(logs), m, 86400.0)) == before


@pytest.fixture(scope="module")
def skewed(spark, make):
    """One user owns about a third of the rows."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(400)}"
        day = 20170201 + rng.randrange(28) if rng.random() < 0.5 else 20170301 + rng.randrange(28)
        rows.append((user, day, day + 10000, rng.randrange(2), 30, 149, rng.choice([0, 99, 149])))
    txn = make.txn(rows).repartition(16)
    users = ["hot"] + [f"u{i}" for i in range(0, 400, 2)]
    cohort = spark.createDataFrame(
        [(u, D(2017, m, 10)) for u in users for m in (2, 3)], "msno string, feature_cutoff_date date"
    )
    return txn, cohort


def test_broadcast_and_shuffled_joins_agree(spark, skewed):
    txn, cohort = skewed
    key = lambda df: sorted(map(str, df.collect()))
    assert key(features.txn_features(txn, cohort, hint="broadcast")) == key(features.txn_features(txn, cohort, hint="merge"))


def test_sums_of_logs_do_not_depend_on_row_order(spark, make, one_cohort):
    """Bit-equal rows over several partitionings, with seconds that are no round numbers."""
    rng = random.Random(11)
    rows = [("u", 20170301 + i % 14, rng.random() * 90000, *[rng.randrange(40) for _ in range(5)], rng.randrange(60)) for i in range(4000)]
    logs = make.logs(rows)
    got = set()
    for parts in (1, 3, 16, 61):
        shuffled = logs.orderBy(F.rand(parts)).repartition(parts)
        got.add(str(features.log_features(shuffled, one_cohort("u"), 43573.98123).first()))
    assert len(got) == 1


def test_p99(make, one_cohort, spark):
    logs = make.logs([("u", 20170301 + i, 100.0 * i) for i in range(15)] + [("u", 20170320, 90000.0)])
    import numpy as np

    want = np.percentile([100.0 * i for i in range(15)], 99)
    assert features.p99_secs(logs, one_cohort("u")).first().p99_secs == pytest.approx(want, abs=1e-9)
    assert features.p99_secs(logs, one_cohort("nobody")).first().p99_secs == 86400.0
    want = np.percentile([100.0 * i for i in range(15)] + [86400.0], 99)
    assert features.p99_secs(logs).first().p99_secs == pytest.approx(want, abs=1e-9)


def test_null_rates(make, one_cohort):
    got = features.feature_matrix(
        one_cohort("u", "ghost"), make.txn([("u", 20170301, 20170331, 0)]), make.logs([("z", 20170301, 1.0)]),
        make.members([("u", 20100101)]), 86400.0,
    )
    rates = {r.feature: (r.null_rate, r.feature_group) for r in features.null_rates(got).collect()}
    assert len(rates) == 20
    assert rates["n_txn"] == (0.5, "transaction") and rates["log_days"] == (1.0, "usage")
    assert rates["tenure_days"] == (0.5, "member")


def test_most_users_in_one_pass_as_by_joins(spark, make, skewed):
    """Both ways give equal rows, also for NULL keys, repeated cohort rows and users on one side only."""
    txn, cohort = skewed
    rng = random.Random(11)
    absent = lambda df: df.withColumn("msno", F.expr("nullif(msno, 'absent')"))
    txn = absent(txn.unionByName(make.txn([("absent", 20170210, 20170312, 1), ("only paid", 20170210, 20170312, 0)])))
    logs = make.logs(
        [(rng.choice(["hot", "absent", "only used", f"u{i % 50}"]), 20170201 + rng.randrange(28), rng.choice([None, 50.5, 9e4 * rng.random()])) for i in range(900)]
    )
    members = make.members([("hot", 20100101), ("hot", 20110101), ("u2", 20170305), ("absent", 20100101)])
    odd = [(None, D(2017, 2, 10)), ("u4", None), ("u6", D(2017, 3, 10)), ("nobody", D(2017, 3, 10)), ("u8", D(2016, 1, 1)), ("hot", D(2017, 2, 14))]
    rows = cohort.union(spark.createDataFrame(odd, cohort.schema)).selectExpr("length(msno) AS size", "*", "msno AS txn_dt")
    logs, members = absent(logs), absent(members)
    for last in (None, 20170305):
        args = rows, txn, logs, members, 43573.98, last
        joined, passed = features.feature_matrix(*args), features.feature_matrix(*args, most_users=True)
        assert passed.columns == joined.columns and passed.dtypes == joined.dtypes
        assert sorted(map(str, passed.collect())) == sorted(map(str, joined.collect()))


def test_logs_are_read_once_for_the_threshold(spark, make, one_cohort):
    logs = make.logs([("u", 20170201 + i, 100.0 * i) for i in range(20)])
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    assert features.p99_secs(logs.where(counted("total_secs")), one_cohort("u")).first().p99_secs == pytest.approx(1881.0)
    assert seen.value == 20
