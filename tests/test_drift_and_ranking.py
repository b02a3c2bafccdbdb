import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import drift, ranking


def numpy_psi(base, cur):
    base = np.array([v for v in base if v is not None and not math.isnan(v)], dtype=float)
    cur = np.array([v for v in cur if v is not None and not math.isnan(v)], dtype=float)
    if len(base) == 0 or len(cur) == 0:
        return 0.0
    edges = np.histogram_bin_edges(base, bins=10)
    edges[-1] = np.inf
    share = lambda x: np.maximum(np.histogram(x, edges)[0] / len(x), 0)
    b, c = share(base), share(cur)
    b[b == 0], c[c == 0] = 1e-4, 1e-4
    return float(((c - b) * np.log(c / b)).sum())


rng = np.random.default_rng(11)
CASES = {
    "shifted": (rng.normal(0, 1, 500), rng.normal(0.5, 1.3, 400)),
    "constant": ([3.0] * 50, [1.0, 2.5, 3.0, 99.0]),
    "below": (rng.uniform(10, 20, 100), [5.0, 11.0, 12.0, 19.0]),
    "above": (rng.uniform(0, 1, 100), [0.5, 7.0, 8.0]),
    "gaps": ([1.0, None, float("nan"), 2.0, 9.0], [None, float("nan"), 2.0, 2.0]),
    "empty_base": ([None, None], [1.0, 2.0]),
    "empty_current": ([1.0, 2.0], [None, float("nan")]),
    "same": (list(range(100)), list(range(100))),
    "binary": ([0, 1] * 50, [0] * 70 + [1] * 30),
}


@pytest.mark.parametrize("case", CASES)
def test_psi_matches_numpy(spark, case):
    base, cur = ([(None if v is None else float(v),) for v in side] for side in CASES[case])
    got = drift.psi_single(spark.createDataFrame(base, "x double"), spark.createDataFrame(cur, "x double"), "x")
    assert got.count() == 1
    assert got.first().psi == pytest.approx(numpy_psi(*[[v[0] for v in s] for s in (base, cur)]), abs=1e-9)


def test_drift_over_columns(spark):
    base = spark.createDataFrame([(float(i), i % 2, None) for i in range(50)], "a double, b int, c double")
    cur = spark.createDataFrame([(float(i + 60), i % 2, 1.0) for i in range(50)], "a double, b int, c double")
    psi = drift.feature_drift(base, cur, ["a", "b", "c"])
    got = {r.feature: r.psi for r in psi.collect()}
    assert got["a"] > 1 and got["b"] == 0.0 and got["c"] == 0.0
    alert = drift.drift_alerts(psi).first()
    assert (alert.n_drifted_features, alert.drifted_features) == (1, "a")
    with pytest.raises(ValueError, match="missing"):
        drift.feature_drift(base, cur.drop("b"), ["a", "b"])
    with pytest.raises(ValueError):
        drift.drift_alerts(psi, 0)


def test_stored_histograms_give_the_same_drift(spark, tmp_path):
    base = spark.range(300).selectExpr("id % 37 / 3D AS a", "IF(id % 5 = 0, NULL, id) AS b", "CAST(NULL AS DOUBLE) AS c", "id % 2 AS half")
    cur = spark.range(90).selectExpr("id % 11 / 2D AS a", "id - 9 AS b", "1D AS c")
    names = ["a", "b", "c"]
    whole = drift.histograms(base, names)
    whole.write.parquet(str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    want = sorted(map(tuple, drift.feature_drift(base, cur, names).collect()))
    assert sorted(map(tuple, drift.drift_from(stored, cur, names).collect())) == want and len(want) == 3

    halves = [drift.histograms(base.where(f"half = {i}"), names, ranges=stored) for i in (0, 1)]
    added = drift.add_histograms(halves[0].unionByName(halves[1]))
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, stored.collect()))
    with pytest.raises(Exception, match="different ranges"):
        drift.add_histograms(stored.unionByName(stored.withColumn("lo", F.col("lo") - 1))).collect()
    with pytest.raises(Exception, match="number of bins"):
        drift.drift_from(stored, cur, names, bins=5).collect()


def scored(spark, pairs):
    return spark.createDataFrame(
        [(f"u{i:05d}", float(s), int(y)) for i, (y, s) in enumerate(pairs)], "msno string, score double, is_churn short"
    )


def brute(pairs, k):
    y = np.array([p[0] for p in pairs], dtype=float)
    s = np.array([p[1] for p in pairs], dtype=float)
    pos, neg = s[y == 1], s[y == 0]
    ap = 0.0
    for v in sorted(set(s), reverse=True):
        at, above = (s == v), (s >= v)
        ap += y[at].sum() / y.sum() * (y[above].sum() / above.sum())
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    order = sorted(range(len(s)), key=lambda i: (-s[i], i))[:k]
    return ap, wins / (len(pos) * len(neg)), y[order].mean(), y[order].sum() / y.sum()


def check(row, want):
    got = (row.auc_pr, row.auc_roc, row.precision_at_k, row.recall_at_k)
    assert got == pytest.approx(want, abs=1e-9)


def test_known_example(spark):
    pairs = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.7), (0, 0.4), (1, 0.2)]
    row = ranking.ranking_metrics(scored(spark, pairs), 3).first()
    assert row.auc_pr == pytest.approx(2 / 3, abs=1e-6) and row.auc_roc == pytest.approx(0.5)
    check(row, brute(pairs, 3))
    assert (row.n_total, row.n_churned, row.top_k) == (6, 3, 3)


@pytest.mark.parametrize("parts", [1, 23])
@pytest.mark.parametrize("decimals", [1, 6])
def test_random_with_ties(spark, parts, decimals):
    r = np.random.default_rng(5)
    n = 600
    s = np.round(np.where(np.arange(n) % 3 == 0, 0.95, r.uniform(0, 1, n)), decimals)
    pairs = list(zip((r.uniform(0, 1, n) < 0.2 + 0.5 * s).astype(int), s))
    check(ranking.ranking_metrics(scored(spark, pairs), 50, parts).first(), brute(pairs, 50))


def test_degenerate_labels(spark):
    ones = ranking.ranking_metrics(scored(spark, [(1, 0.3), (1, 0.6)]), 10).first()
    assert ones.auc_pr is None and ones.auc_roc is None and ones.precision_at_k == 1.0
    zeros = ranking.ranking_metrics(scored(spark, [(0, 0.3), (0, 0.6)]), 10).first()
    assert zeros.auc_pr is None and zeros.recall_at_k == 0.0
    tied = ranking.ranking_metrics(scored(spark, [(1, 0.5), (0, 0.5), (0, 0.5), (0, 0.5)]), 2).first()
    assert tied.auc_pr == 0.25 and tied.auc_roc == 0.5 and tied.precision_at_k == 0.5


def test_cohort_performance_and_empty_match(spark):
    pred = scored(spark, [(1, 0.9), (0, 0.1), (1, 0.2)])
    out = ranking.cohort_performance(pred, pred.select("msno", "is_churn"), 2).first()
    assert out.auc_pr_alert is False and out.n_total == 3
    other = pred.select("is_churn").selectExpr("'nobody' AS msno", "is_churn")
    empty = ranking.cohort_performance(pred, other).first()
    assert empty.n_total == 0 and empty.auc_pr is None and empty.auc_pr_alert is False
    with pytest.raises(ValueError):
        ranking.cohort_performance(pred, pred, alert_below=1.0)


def test_candidate_decision(spark):
    good = scored(spark, [(1, 0.9), (0, 0.1), (1, 0.8), (0, 0.3)])
    bad = scored(spark, [(1, 0.1), (0, 0.9), (1, 0.8), (0, 0.3)])
    assert ranking.candidate_decision(good, bad).first().promoted is True
    assert ranking.candidate_decision(bad, good).first().promoted is False
    assert ranking.candidate_decision(good, good).first().promoted is False  # a tie does not win
    first = ranking.candidate_decision(bad, None).first()
    assert first.promoted is True and first.test_auc_pr_production == 0.0


def test_top_k_breaks_ties_by_user(spark):
    rows = scored(spark, [(1, 0.5), (0, 0.5), (1, 0.9)])
    assert [r.msno for r in ranking.top_k(rows, 2).collect()] == ["u00002", "u00000"]


def test_metrics_of_many_series_equal_those_of_each(spark):
    import random

    from pyspark.sql import functions as F

    from stayline.operators.ranking import ranking_metrics, ranking_metrics_by

    rng = random.Random(6)
    rows = [(s, f"u{i}", rng.randrange(12) / 11, int(rng.random() < 0.3)) for s, n in (("big", 300), ("a", 9), ("b", 1), (None, 20)) for i in range(n)]
    rows += [("all", f"u{i}", 0.5, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "series string, msno string, score double, is_churn int").repartition(4)
    got = {r.series: r for r in ranking_metrics_by(df, ["series"], k=5, parts=6).collect()}
    assert set(got) == {"big", "a", "b", None, "all"}
    for name, row in got.items():
        one = ranking_metrics(df.where(F.col("series").eqNullSafe(F.lit(name))), k=5).first().asDict()
        mine = row.asDict()
        for c, v in one.items():
            assert mine[c] == (v if v is None else pytest.approx(v, abs=1e-12)), (name, c)
    assert ranking_metrics_by(df.limit(0), ["series"]).count() == 0
    with pytest.raises(ValueError):
        ranking_metrics_by(df, ["series"], k=0)
