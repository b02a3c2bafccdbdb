"""The jobs end to end, and the shape of the plans they run."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stayline.functions.dates import int_to_date
from stayline.operators import cohort, features, labels, model, pit, ranking
from stayline.operators.drift import feature_drift
from stayline.plans import dataset, labeling, monitoring, scoring, training
from stayline.schemas import FEATURES
from stayline.session import scratch_path, stage
from stayline.sources import readers
from workload.q_scoring import demo_scorer
from workload.tables import Tables

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def t(spark):
    t = Tables(spark, FOLDER)
    for name in ("transactions", "user_logs", "members"):  # stored sources, as in a real run
        setattr(t, name, stage(getattr(t, name), name))
    return t


@pytest.fixture(scope="module")
def label_store(spark, t):
    store = scratch_path(spark, "e2e-labels")
    for month in ("2001-03", "2001-04", "2001-05", "2001-06"):
        health = labeling.run_labeling(t.transactions, month, "2001-09-01", store)
        assert {r.metric for r in health.collect()} == {"cohort_size", "labels_written", "churn_rate"}
    return store


@pytest.fixture(scope="module")
def built(spark, t, label_store):
    root = scratch_path(spark, "e2e-dataset")
    stored = spark.read.parquet(label_store)
    summary = dataset.build_dataset(stored, t.transactions, t.user_logs, t.members, root, "v1")
    return root, {r.split: r.n for r in summary.collect()}


@pytest.fixture(scope="module")
def fitted(spark, built):
    return training.train(spark, built[0], "v1", rounds=3)


def test_labels_then_dataset(spark, label_store, built):
    root, sizes = built
    stored = spark.read.parquet(label_store)
    assert sum(sizes.values()) == stored.count() and set(sizes) == {"train", "val", "test"}
    baseline = readers.drift_baseline(spark, root, "v1", FEATURES)
    assert baseline.count() == sizes["train"] + sizes["val"] and baseline.columns == FEATURES
    assert readers.dataset_params(spark, root, "v1").count() == 1
    assert readers.dataset_split(spark, root, "nope", "train").count() == 0


def test_labeling_an_empty_month(spark, t):
    store = scratch_path(spark, "e2e-empty")
    got = {r.metric: (r.value, r.alert) for r in labeling.run_labeling(t.transactions, "2031-01", "2031-03-01", store).collect()}
    assert got["cohort_size"] == (0.0, True) and got["labels_written"] == (0.0, False) and got["churn_rate"] == (0.0, False)


def test_dataset_without_rows_is_an_error(spark, t, label_store):
    with pytest.raises(ValueError, match="no labeled rows"):
        dataset.build_dataset(
            spark.read.parquet(label_store), t.transactions, t.user_logs, t.members, scratch_path(spark, "x"), "v1", ["1990-01"]
        )


def test_train_and_validate(spark, built, fitted):
    model_, health = fitted
    assert {r.metric for r in health.collect()} >= {"val_auc_pr", "n_train", "n_val"}
    decision, metrics = training.validate(spark, built[0], "v1", model_, None)
    assert decision.first().promoted is True and metrics.count() == 6
    decision, _ = training.validate(spark, built[0], "v1", model_, model_)
    assert decision.first().promoted is False
    with pytest.raises(ValueError, match="empty"):
        training.train(spark, built[0], "v2")


def test_score_store_drift_performance(spark, t, label_store, built, fitted):
    root, _ = built
    store = scratch_path(spark, "e2e-pred")
    p99 = readers.dataset_params(spark, root, "v1").select("p99_secs").scalar()
    scorer = lambda df: model.score(df, fitted[0])
    for day in ("2001-03-01", "2001-03-02"):
        scored, health = scoring.run_scoring(
            t.transactions, t.user_logs, t.members, day, scorer, p99, "m1", store, dt.datetime(2001, 3, 2)
        )
    rows = {r.metric: r.value for r in health.collect()}
    assert len(rows) == 12 and rows["cohort_size"] == rows["rows_written"] == scored.count()
    stored = spark.read.parquet(store)
    assert stored.select("msno", "scoring_date").distinct().count() == stored.count()

    rebuilt = monitoring.features_of_scored(stored, "2001-03-02", t.transactions, t.user_logs, t.members, root, "v1")
    a = sorted(map(str, rebuilt.select("msno", *FEATURES).collect()))
    assert a == sorted(map(str, scored.select("msno", *FEATURES).collect()))  # one path for both

    psi, alert = monitoring.run_drift(scored, root, "v1")
    direct = feature_drift(readers.drift_baseline(spark, root, "v1", FEATURES), scored, FEATURES)
    assert sorted(map(tuple, psi.collect())) == sorted(map(tuple, direct.collect()))
    assert psi.count() == len(FEATURES)
    assert alert.first().n_drifted_features == psi.where("psi > 0.2").count()

    perf = monitoring.run_performance(stored, spark.read.parquet(label_store), "2001-03").first()
    assert perf.n_total > 0 and perf.retrain == (perf.auc_pr is not None and perf.auc_pr < 0.45)
    nothing = monitoring.run_performance(stored, spark.read.parquet(label_store), "1999-01").first()
    assert nothing.auc_pr_alert is True and nothing.retrain is False


def test_scoring_a_day_without_cohort(spark, t):
    store = scratch_path(spark, "e2e-none")
    scored, health = scoring.run_scoring(
        t.transactions, t.user_logs, t.members, "2031-01-01", demo_scorer, 86400.0, "m1", store, dt.datetime(2031, 1, 1)
    )
    assert scored.count() == 0
    assert {r.metric: r.alert for r in health.collect()}["cohort_size"] is True


def test_model_learns_a_planted_signal(spark):
    rows = spark.range(1200).select(
        F.col("id").cast("string").alias("msno"),
        *[
            (F.when(F.col("id") % 7 == 0, None).otherwise((F.hash("id", F.lit(i)) % 5) + 5)).cast("int").alias(c)
            for i, c in enumerate(FEATURES)
        ],
        (F.col("id") % 2).cast("int").alias("is_churn"),
        F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
    ).withColumn("n_txn", F.when(F.col("is_churn") == 1, F.lit(None)).otherwise(F.col("n_txn")))
    rows = stage(rows, "planted")
    fit = model.fit_gbt(rows, rounds=3, depth=3)
    means = {r.is_churn: r.m for r in model.score(rows, fit).groupBy("is_churn").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > means[0] + 0.1  # a missing value is a signal of its own
    top = model.feature_importance(fit, rows).first()
    assert top.feature == "n_txn"


def test_opaque_models(spark):
    import numpy as np

    class Proba:
        def predict_proba(self, x):
            p = x["a"].to_numpy(dtype=float)
            return np.stack([1 - p, p], axis=1)

    class Short:
        def predict(self, x):
            return np.zeros(max(len(x) - 1, 0))

    df = spark.createDataFrame([("u", 0.25), ("v", 0.75)], "msno string, a double")
    assert {r.msno: r.score for r in model.score_with(df, Proba, ["a"]).collect()} == {"u": 0.25, "v": 0.75}
    with pytest.raises(Exception, match="scores for"):
        model.score_with(df, Short, ["a"]).collect()
    with pytest.raises(ValueError, match="missing"):
        model.score_with(df, Proba, ["b"])


# ── plan shape ───────────────────────────────────────────────────────────────


@pytest.fixture(scope="module", autouse=True)
def full_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NO_PYTHON = [
    "churn_labels", "label_cohort", "feature_matrix", "training_set", "risk_tiers", "feature_drift",
    "holdout_metrics", "secs_percentiles", "upsert_predictions", "log_coverage",
]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_in_the_core(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoop", text)


def test_labels_are_one_scan_one_shuffle_and_prune(t):
    text = plan(labels.month_labels(t.transactions, "2001-03", "2001-05-01"))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text
    assert re.search(r"PushedFilters: \[.*membership_expire_date.*20010301", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "plan_list_price" not in schema and "payment_method_id" not in schema


def test_cohort_filter_reaches_the_scan(t):
    text = plan(cohort.expiring_cohort(t.transactions, "2001-03-01"))
    assert "EqualTo(membership_expire_date,20010315)" in text


def test_known_size_of_a_cohort_decides_the_join(spark, t):
    """The stored cohort is broadcast below Spark's threshold; a hint or a lower threshold shuffles both sides."""
    users = pit.staged_cohort(cohort.label_cohort(t.transactions, "2001-03"))
    text = plan(features.txn_features(t.transactions, users, last_cutoff=20010317))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "LessThanOrEqual(transaction_date,20010317)" in text
    assert "partial_max" in text
    # The one window merges a user's intervals, which are already a row per cutoff.
    (window,) = re.findall(r"Window \[.*", text)
    assert re.search(r"\], \[msno#\d+\], \[feature_cutoff_date#\d+ ASC", window)
    assert re.search(r"Aggregate\(key(s)?=\[msno#\d+, feature_cutoff_date#", text.split("Window [")[1])
    forced = plan(features.txn_features(t.transactions, users, last_cutoff=20010317, hint="merge"))
    assert "SortMergeJoin" in forced and "BroadcastHashJoin" not in forced


def test_facts_are_a_row_per_user_and_day_before_the_join(t):
    users = pit.staged_cohort(cohort.label_cohort(t.transactions, "2001-03"))
    for df in (features.txn_features(t.transactions, users, hint="merge"), features.log_features(t.user_logs, users, 1.0, hint="merge")):
        below_join = plan(df).split("SortMergeJoin")[1]
        assert re.search(r"Aggregate\(key(s)?=\[msno#\d+, (transaction_date|date)#", below_join)


def test_facts_are_not_copied_for_later_cutoffs(spark, t):
    """After the join there are at most as many rows as user-days and cohort rows, for any number of cutoffs."""
    days = t.user_logs.select("msno", int_to_date("date").alias("log_dt")).distinct()
    users = stage(t.user_logs.select("msno").distinct().crossJoin(spark.range(40)).select(
        "msno", F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") * 60).cast("int")).alias("feature_cutoff_date")), "many-cutoffs")
    intervals = pit.in_intervals(days, users, "log_dt")
    assert intervals.count() <= days.count() + users.count()
    got = pit.running_totals(intervals.groupBy("msno", "feature_cutoff_date").agg(F.count("log_dt").alias("n"), F.max("log_dt").alias("last")), ["n"], ["last"])
    pairs = users.join(days, "msno").where("log_dt <= feature_cutoff_date")
    want = pairs.groupBy("msno", "feature_cutoff_date").agg(F.count("*").alias("n"), F.max("log_dt").alias("last"))
    assert got.where("n > 0").exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    times = pit.times_counted(days, users, "log_dt", "times").agg(F.sum("times")).first()[0]
    assert times == pairs.count()


def test_training_features_meet_in_one_sort(t):
    """Payments, usage and cohort rows of labeled users share a shuffle and a window; only members are joined."""
    users = pit.staged_cohort(labels.month_labels(t.transactions, "2001-03", "2001-05-01"))
    text = plan(dataset.labeled_features(users, t.transactions, t.user_logs, t.members, 43573.98))
    assert text.count("Window [") == 1 and text.count("Join ") == 1


def test_renewals_are_found_without_a_sort_of_days(t):
    stored = pit.staged_cohort(cohort.label_cohort(t.transactions, "2001-03"))
    assert "Window" not in plan(labels.next_renewals(stored, t.transactions))


def test_renewals_take_one_shuffle_of_payments(t):
    from stayline.operators.labels import with_renewal

    stored = pit.staged_cohort(cohort.label_cohort(t.transactions, "2001-03"))
    text = plan(with_renewal(stored, t.transactions))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text and "partial_collect_set" in text


def test_coverage_and_rebuilt_features_bound_their_scans(t):
    from stayline.operators.agreement import log_coverage

    text = plan(log_coverage(cohort.label_cohort(t.transactions, "2001-03"), t.user_logs, 20010317))
    assert "LessThanOrEqual(date,20010317)" in text


def test_windows_over_everything_only_see_bucket_totals(spark, t):
    """The one unpartitioned window reads a row per bucket, and there are as many buckets as shuffle partitions."""
    from stayline.operators.running import bucketed, running_sums

    per_score = t.user_logs.groupBy(F.col("total_secs").alias("score")).agg(F.count("*").alias("tp"))
    text = plan(running_sums(per_score, "score", ["tp"]))
    blocks = re.findall(r"Window \[.*?\], \[_bucket#\d+ DESC.*", text)
    assert len(blocks) == 1
    assert re.search(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[_bucket", text)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (3, 300):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            assert 0.8 * n <= bucketed(spark.range(5000), ["id"]).select("_bucket").distinct().count() <= n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_rounds_are_cut_at_the_best_not_at_the_first_stop():
    losses = [1.0, 0.9, 0.95, 0.93, 0.8, 0.85, 0.84, 0.86, 0.7]
    assert model.best_prefix(losses, 3) == 5  # past the first rise, and before the patience ran out
    assert model.best_prefix(losses, 1) == 2 and model.best_prefix(losses, 50) == 9 and model.best_prefix([1.0], 5) == 1


def test_a_cut_model_scores_as_its_first_trees(spark):
    rows = stage(spark.range(400).select(
        F.col("id").cast("string").alias("msno"), *[(F.hash("id", F.lit(i)) % 5).cast("int").alias(c) for i, c in enumerate(FEATURES)],
        (F.hash("id") % 2 == 0).cast("int").alias("is_churn"), F.lit("train").alias("split"),
    ), "cut")
    long, short = (model.fit_gbt(rows, rounds=n, depth=2) for n in (5, 2))
    cut = model.PipelineModel([*long.stages[:-1], model.first_rounds(long.stages[-1], 2)])
    a, b = (sorted(model.score(rows, m).select("msno", "score").collect()) for m in (cut, short))
    assert a == b


def test_rounds_are_ranked_in_one_pass(spark):
    rows = stage(spark.range(600).select(
        F.col("id").cast("string").alias("msno"), *[(F.hash("id", F.lit(i)) % 7).cast("int").alias(c) for i, c in enumerate(FEATURES)],
        (F.hash("id", F.lit(0)) % 7 + F.hash("id", F.lit(99)) % 4 > 0).cast("int").alias("is_churn"),
        F.when(F.col("id") < 400, "train").otherwise("val").alias("split"),
    ), "rounds")
    whole = model.fit_gbt(rows.where("split = 'train'"), rounds=6, depth=2)
    val = model.PipelineModel(whole.stages[:-1]).transform(model.encode(rows.where("split = 'val'")))
    margins = model.margins_by_round(whole.stages[-1], val)
    assert margins.count() == 6 * 200
    last = sorted(r.score for r in margins.where("round = 6").collect())
    raw = whole.transform(model.encode(rows.where("split = 'val'"))).select(model.vector_to_array("rawPrediction")[1].alias("m"))
    assert last == pytest.approx(sorted(r.m for r in raw.collect()), abs=1e-12)

    curve = {r["round"]: r.auc_pr for r in ranking.average_precision_by(margins, ["round"]).collect()}
    for n in range(1, 7):
        cut = model.PipelineModel([*whole.stages[:-1], model.first_rounds(whole.stages[-1], n)])
        want = ranking.ranking_metrics(model.score(rows.where("split = 'val'"), cut)).first().auc_pr
        assert curve[n] == pytest.approx(want, abs=1e-9)
    best = max(curve, key=lambda n: (curve[n], -n))
    assert model.fit_gbt(rows, rounds=6, depth=2).stages[-1].getNumTrees == best
    assert model.fit_gbt(rows.where("split = 'train' OR is_churn = 1"), rounds=2, depth=2).stages[-1].getNumTrees == 2
    with pytest.raises(ValueError, match="measure"):
        model.fit_gbt(rows, stop_on="accuracy")
