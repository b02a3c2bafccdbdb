import json

import pytest
from pyspark.sql import functions as F

from stayline.operators import checks, splits, tiers
from stayline.operators.tiers import Tier


def test_tier_edges(spark):
    scores = [0.0, 0.1999999, 0.2, 0.4999999, 0.5, 1.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = [r.risk_tier for r in tiers.with_risk_tier(df).collect()]
    assert got == ["LOW", "LOW", "MED", "MED", "HIGH", "HIGH", None]


@pytest.mark.parametrize("bad", [-0.01, 1.01, float("nan")])
def test_scores_outside_the_unit_interval_fail(spark, bad):
    df = spark.createDataFrame([(0.5,), (bad,)], "score double")
    with pytest.raises(Exception, match="outside"):
        tiers.with_risk_tier(df).collect()


def tier_set(*bounds, names=("LOW", "MED", "HIGH")):
    return tuple(Tier(n, lo, hi) for n, (lo, hi) in zip(names, bounds))


@pytest.mark.parametrize(
    "bad",
    [
        tier_set((0.0, 0.2), (0.3, 0.5), (0.5, 1.0)),
        tier_set((0.0, 0.3), (0.2, 0.5), (0.5, 1.0)),
        tier_set((0.1, 0.2), (0.2, 0.5), (0.5, 1.0)),
        tier_set((0.0, 0.2), (0.2, 0.5), (0.5, 0.9)),
        tier_set((0.0, 0.2), (0.2, 0.5), (0.5, 1.0), names=("LOW", "LOW", "HIGH")),
        tier_set((0.0, 0.5), (0.5, 1.0)),
        tier_set((0.2, 0.0), (0.2, 0.5), (0.5, 1.0)),
    ],
)
def test_bad_configs(bad):
    with pytest.raises(ValueError):
        tiers.check_tiers(bad)


def test_open_bound_leaves_an_unmatched_score(spark):
    custom = (Tier("HIGH", 0.5, 1.0, True, False), *tiers.DEFAULT_TIERS[1:])
    with pytest.raises(Exception, match="no tier"):
        spark.createDataFrame([(1.0,)], "score double").select(tiers.risk_tier(F.col("score"), custom)).collect()


def test_load_tiers(tmp_path):
    path = tmp_path / "tiers.json"
    rows = [t.__dict__ for t in tiers.DEFAULT_TIERS]
    path.write_text(json.dumps({"strategy": "fixed_threshold", "tiers": rows}))
    assert tiers.load_tiers(str(path)) == tiers.DEFAULT_TIERS
    for broken in ([{**rows[0], "score_min": "low"}, *rows[1:]], [{"name": "HIGH"}, *rows[1:]], []):
        path.write_text(json.dumps({"tiers": broken}))
        with pytest.raises(ValueError):
            tiers.load_tiers(str(path))
    path.write_text(json.dumps({"strategy": "percentile", "tiers": rows}))
    with pytest.raises(ValueError, match="strategy"):
        tiers.load_tiers(str(path))


def month_rows(spark, months, n=200):
    return spark.createDataFrame(
        [(f"u{i}", months[i % len(months)], i % 2) for i in range(n)], "msno string, cohort_month string, is_churn int"
    )


def sizes(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


def test_three_months_split_by_time(spark):
    got = splits.split_3way(month_rows(spark, ["2017-01", "2017-02", "2017-03", "2016-12", None]))
    by_month = {(r.cohort_month, r.split) for r in got.select("cohort_month", "split").distinct().collect()}
    assert by_month == {("2017-03", "test"), ("2017-02", "val"), ("2017-01", "train"), ("2016-12", "train"), (None, "train")}


def test_few_months(spark):
    one = sizes(splits.split_3way(month_rows(spark, ["2017-01"], 2000)))
    assert sum(one.values()) == 2000 and 200 < one["test"] < 400 and 200 < one["val"] < 400
    two = month_rows(spark, ["2017-01", "2017-02"])
    assert set(sizes(splits.split_3way(two))) == {"train", "val", "test"}
    assert sizes(splits.split_2way(two)) == {"train": 100, "val": 100}
    assert set(sizes(splits.split_2way(month_rows(spark, ["2017-01"])))) == {"train", "val"}


def test_random_split_ignores_row_order_and_is_stratified(spark):
    df = month_rows(spark, ["2017-01"], 3000).drop("cohort_month")
    a = {(r.msno, r.split) for r in splits.split_3way(df).collect()}
    b = {(r.msno, r.split) for r in splits.split_3way(df.repartition(7).orderBy(F.rand(3))).collect()}
    assert a == b and len(a) == 3000
    rates = splits.split_3way(df).groupBy("split").agg(F.avg("is_churn").alias("r")).collect()
    assert all(abs(r.r - 0.5) < 0.06 for r in rates)
    assert a != {(r.msno, r.split) for r in splits.split_3way(df, seed=1).collect()}


@pytest.mark.parametrize("fractions", [(0.5, 0.5), (0.0, 0.2), (1.0, 0.1)])
def test_bad_fractions(spark, fractions):
    with pytest.raises(ValueError):
        splits.split_3way(month_rows(spark, ["2017-01"]), *fractions)


def test_constraints(spark):
    df = spark.createDataFrame(
        [("a", 1, "LOW"), ("a", 1, "MED"), ("b", 2, None), ("c!", 3, "TOP")], "msno string, d int, risk_tier string"
    )
    rules = {"tier": ~F.col("risk_tier").isin("HIGH", "MED", "LOW"), "user": ~F.col("msno").rlike(checks.USER_ID_PATTERN)}
    got = {r.check_name: r.n_violations for r in checks.count_violations(df, rules, ["msno", "d"]).collect()}
    assert got == {"tier": 2, "user": 1, "duplicate_key": 1}
    assert {r.msno for r in checks.domain_violations(df, "risk_tier", ["HIGH", "MED", "LOW"]).collect()} == {"b", "c!"}
    with pytest.raises(ValueError, match="duplicate"):
        checks.assert_unique(df, ["msno", "d"])
    checks.assert_unique(df, ["msno", "d", "risk_tier"])
