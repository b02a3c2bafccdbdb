"""Scores, stores, reads, metrics, health and the model."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.functions.numbers import round_half_away
from stayline.operators import boosting, health, labels, model, ranking, reads, splits, tiers
from stayline.plans.monitoring import features_of_scored, run_performance
from stayline.plans.scoring import scored_cohort as plan_scored_cohort
from stayline.schemas import CATEGORICAL_FEATURES, FEATURES
from stayline.session import scratch_path, stage
from stayline.sources import writers
from stayline.sources.readers import read_sql
from workload.oracle import FEATURE_LIST, WITH, boosting_sql, features_sql, metrics_sql
from workload.q_cohort import LABELED, MONTH, TRAIN_MONTHS, train_labels, train_rows
from workload.registry import query
from workload.tables import Tables

TIER_SQL = "CASE WHEN score >= 0.5 THEN 'HIGH' WHEN score >= 0.2 THEN 'MED' ELSE 'LOW' END"
STAMP = datetime(2001, 4, 1)


def r8(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: round_half_away(F.col(n), 8) for n in names})


# ── tiers and distributions ──────────────────────────────────────────────────


@query(WITH + f"SELECT msno, scoring_date, score, {TIER_SQL} AS risk_tier FROM sub_predictions")
def risk_tiers(t: Tables) -> DataFrame:
    return tiers.with_risk_tier(t.predictions).select("msno", "scoring_date", "score", "risk_tier")


@query(WITH + f"""
SELECT {TIER_SQL} AS risk_tier, count(*) AS cnt, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM sub_predictions GROUP BY 1""")
def tier_distribution(t: Tables) -> DataFrame:
    return r8(tiers.tier_distribution(tiers.with_risk_tier(t.predictions)), "share")


@query(WITH + """
SELECT count(score) AS n_users, min(score) AS min, max(score) AS max, round(avg(score), 8) AS mean,
  round(quantile_cont(score, 0.5), 8) AS p50, round(quantile_cont(score, 0.9), 8) AS p90 FROM sub_predictions""")
def score_distribution(t: Tables) -> DataFrame:
    return r8(health.score_distribution(t.predictions), "mean", "p50", "p90")


@query(WITH + "SELECT msno, score, expiry_date FROM sub_predictions ORDER BY score DESC, msno, expiry_date LIMIT 100")
def top_k_risk(t: Tables) -> DataFrame:
    return ranking.top_k(t.predictions.select("msno", "score", "expiry_date"), 100, ["expiry_date"])


# ── stores and reads ─────────────────────────────────────────────────────────


CREATED = "TIMESTAMP '2001-06-01 00:00:00'"
STORED = ["msno", "score", "risk_tier", "scoring_date", "expiry_date", "model_version", "created_at"]


def _stored_run(scored: DataFrame) -> DataFrame:
    """Predictions as a backfill writes them."""
    stamp = F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    return tiers.with_risk_tier(scored).withColumn("created_at", stamp).select(*STORED)


@query(WITH + """
, old AS (SELECT c.*, CAST(CASE WHEN EXISTS (SELECT 1 FROM sub_transactions t WHERE t.msno = c.msno AND t.is_cancel = 0
      AND t.membership_expire_date >= t.transaction_date
      AND CAST(strptime(CAST(t.transaction_date AS VARCHAR), '%Y%m%d') AS DATE) > c.anchor_expiry_date
      AND CAST(strptime(CAST(t.transaction_date AS VARCHAR), '%Y%m%d') AS DATE) <= c.anchor_expiry_date + 7)
    THEN 0 ELSE 1 END AS SMALLINT) AS is_churn, DATE '2001-05-01' AS labeled_date FROM tcohort c)
SELECT coalesce(n.msno, o.msno) AS msno, coalesce(n.anchor_expiry_date, o.anchor_expiry_date) AS anchor_expiry_date,
  coalesce(n.feature_cutoff_date, o.feature_cutoff_date) AS feature_cutoff_date, coalesce(n.is_churn, o.is_churn) AS is_churn,
  coalesce(n.labeled_date, o.labeled_date) AS labeled_date
FROM old o FULL JOIN (SELECT * REPLACE (DATE '2001-06-01' AS labeled_date) FROM labels03) n
  ON n.msno = o.msno AND n.anchor_expiry_date = o.anchor_expiry_date""")
def upsert_labels(t: Tables) -> DataFrame:
    store = scratch_path(t.spark, "label-store")
    early = labels.churn_labels(
        train_labels(t).select("msno", "anchor_expiry_date", "feature_cutoff_date"), t.transactions, LABELED, window_days=7
    )
    writers.upsert_labels(early, store)
    final = labels.month_labels(t.transactions, MONTH, "2001-06-01")
    writers.upsert_labels(final, store)
    writers.upsert_labels(final, store)
    return t.spark.read.parquet(store).drop("cohort_month")


@query(WITH + f"""
, run AS (SELECT * REPLACE (CASE WHEN strftime(expiry_date, '%Y-%m') = '2001-03' THEN rival_score ELSE score END AS score,
    CASE WHEN strftime(expiry_date, '%Y-%m') = '2001-03' THEN 'm3' ELSE model_version END AS model_version) FROM sub_predictions)
SELECT msno, score, {TIER_SQL} AS risk_tier, scoring_date, expiry_date, model_version, {CREATED} AS created_at FROM run""")
def upsert_predictions(t: Tables) -> DataFrame:
    """All predictions, then one month scored again by another model."""
    store = scratch_path(t.spark, "prediction-store")
    month = F.date_format("expiry_date", "yyyy-MM") == MONTH
    again = t.predictions.where(month).withColumns({"score": F.col("rival_score"), "model_version": F.lit("m3")})
    writers.upsert_predictions(_stored_run(t.predictions), store)
    writers.upsert_predictions(_stored_run(again), store)
    return t.spark.read.parquet(store)


@query(WITH + f"""
SELECT msno, CAST(CAST(score AS FLOAT) AS DOUBLE) AS score, {TIER_SQL} AS risk_tier, scoring_date, expiry_date,
  model_version, {CREATED} AS created_at FROM sub_predictions""")
def predictions_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "predictions")
    writers.write_predictions(_stored_run(t.predictions), path)
    return t.spark.read.parquet(path).withColumn("score", F.col("score").cast("double"))


@query(WITH + "SELECT msno, score, expiry_date FROM sub_predictions WHERE strftime(expiry_date, '%Y-%m') = '2001-03'")
def predictions_for_month(t: Tables) -> DataFrame:
    return reads.predictions_for_month(t.predictions, MONTH)


@query(WITH + """
SELECT msno, scoring_date, score, expiry_date, model_version FROM (
  SELECT *, row_number() OVER (PARTITION BY msno ORDER BY scoring_date DESC) AS rn FROM sub_predictions) WHERE rn = 1""")
def latest_prediction(t: Tables) -> DataFrame:
    return reads.latest_prediction(t.predictions.drop("rival_score"))


@query(WITH + f"""
SELECT msno, score, {TIER_SQL} AS risk_tier, expiry_date, model_version,
  count(*) OVER () AS count FROM sub_predictions WHERE scoring_date = DATE '2001-03-01'""")
def cohort_for_date(t: Tables) -> DataFrame:
    return reads.cohort_for_date(tiers.with_risk_tier(t.predictions), "2001-03-01")


# ── ranking metrics ──────────────────────────────────────────────────────────

_METRICS = ("auc_pr", "auc_roc", "precision_at_k", "recall_at_k")

SCORED = """
, perf AS (SELECT p.msno, p.score, l.is_churn FROM sub_predictions p JOIN labels03 l ON l.msno = p.msno
    WHERE strftime(p.expiry_date, '%Y-%m') = '2001-03')
, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY scoring_date DESC) AS rn FROM sub_predictions) WHERE rn = 1)
, hold AS (SELECT p.msno, p.score, t.is_churn FROM latest p JOIN sub_train t ON t.msno = p.msno)
, rival AS (SELECT p.msno, p.rival_score AS score, t.is_churn FROM latest p JOIN sub_train t ON t.msno = p.msno)
"""


def _holdout(t: Tables) -> DataFrame:
    return reads.latest_prediction(t.predictions).join(t.train, "msno")


@query(WITH + SCORED + metrics_sql("perf", "m") + "SELECT *, coalesce(auc_pr < 0.45, FALSE) AS auc_pr_alert FROM m")
def cohort_performance(t: Tables) -> DataFrame:
    mine = reads.predictions_for_month(t.predictions, MONTH)
    truth = labels.month_labels(t.transactions, MONTH, LABELED)
    return r8(ranking.cohort_performance(mine, truth), *_METRICS)


@query(WITH + SCORED + metrics_sql("hold", "m") + "SELECT * FROM m")
def holdout_metrics(t: Tables) -> DataFrame:
    return r8(ranking.ranking_metrics(_holdout(t)), *_METRICS)


@query(WITH + SCORED + metrics_sql("hold", "m") + metrics_sql("rival", "c") + """
SELECT c.auc_pr AS test_auc_pr_candidate, c.auc_roc AS test_auc_roc_candidate, c.precision_at_k AS precision_at_k_candidate,
  c.recall_at_k AS recall_at_k_candidate, m.auc_pr AS test_auc_pr_production, c.auc_pr > m.auc_pr AS promoted FROM c, m""")
def candidate_decision(t: Tables) -> DataFrame:
    rows = _holdout(t)
    rival = rows.withColumn("score", F.col("rival_score"))
    out = ranking.candidate_decision(rival, rows)
    return r8(out, *[c for c in out.columns if c != "promoted"])


@query(WITH + SCORED + metrics_sql("hold", "m") + """
, s AS (SELECT count(*) AS n_train, 0 AS n_val FROM sub_train)
SELECT 'val_auc_pr' AS metric, auc_pr AS value, auc_pr < 0.45 AS alert FROM m
UNION ALL SELECT 'val_auc_roc', auc_roc, FALSE FROM m UNION ALL SELECT 'precision_at_k', precision_at_k, FALSE FROM m
UNION ALL SELECT 'recall_at_k', recall_at_k, FALSE FROM m
UNION ALL SELECT 'n_train', CAST(count(*) AS DOUBLE), FALSE FROM sub_train WHERE substr(md5(msno || '|42'), 1, 8) >= '33333333'
UNION ALL SELECT 'n_val', CAST(count(*) AS DOUBLE), FALSE FROM sub_train WHERE substr(md5(msno || '|42'), 1, 8) < '33333333'""")
def training_health(t: Tables) -> DataFrame:
    sizes = health.split_summary(splits.split_2way(t.train))
    return r8(health.training_health(ranking.ranking_metrics(_holdout(t)), sizes), "value")


# ── scoring run and health ───────────────────────────────────────────────────


def demo_scorer(rows: DataFrame) -> DataFrame:
    """A fixed integer formula over features, so that the oracle can repeat the scores."""
    def whole(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    raw = whole("n_txn") * 37 + whole("days_since_last_txn") * 11 + whole("tenure_days")
    return rows.withColumn("score", (raw % 101).cast("double") / 100.0)


SCORE_SQL = """CAST((coalesce(n_txn, 0) * 37 + coalesce(days_since_last_txn, 0) * 11 + coalesce(tenure_days, 0)) % 101 AS DOUBLE) / CAST(100 AS DOUBLE)"""

DAY_COHORT = """
, dcohort AS (SELECT DISTINCT msno, DATE '2001-05-01' AS expiry_date, DATE '2001-04-17' AS feature_cutoff_date
  FROM sub_transactions WHERE membership_expire_date = 20010501 AND membership_expire_date >= transaction_date)
"""


@query(WITH + DAY_COHORT + features_sql("dcohort", "d", "43573.98") + f"""
SELECT *, {TIER_SQL} AS risk_tier FROM (
  SELECT msno, DATE '2001-05-01' AS expiry_date, feature_cutoff_date, {FEATURE_LIST}, {SCORE_SQL} AS score,
    DATE '2001-04-17' AS scoring_date, 'demo-1' AS model_version FROM dmatrix)""")
def scored_cohort(t: Tables) -> DataFrame:
    return plan_scored_cohort(
        t.transactions, t.user_logs, t.members, "2001-04-17", demo_scorer, 43573.98, "demo-1"
    )


def _health_sql() -> str:
    from stayline.schemas import FEATURES, LOG_FEATURES, MEMBER_FEATURES, TXN_FEATURES

    def rate(columns: list[str]) -> str:
        return "(" + " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in columns) + f") / {len(columns)}"

    rows = {
        "cohort_size": ("count(*)", "count(*) < 100"),
        "null_rate_overall": (rate(FEATURES), f"{rate(FEATURES)} > 0.99"),
        "null_rate_txn": (rate(TXN_FEATURES), "FALSE"),
        "null_rate_log": (rate(LOG_FEATURES), "FALSE"),
        "null_rate_member": (rate(MEMBER_FEATURES), "FALSE"),
        "score_mean": ("avg(score)", "FALSE"),
        "score_p50": ("quantile_cont(score, 0.5)", "FALSE"),
        "score_p90": ("quantile_cont(score, 0.9)", "FALSE"),
        "high_tier_pct": ("avg(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END)", "FALSE"),
        "med_tier_pct": ("avg(CASE WHEN score >= 0.2 AND score < 0.5 THEN 1 ELSE 0 END)", "FALSE"),
        "low_tier_pct": ("avg(CASE WHEN score < 0.2 THEN 1 ELSE 0 END)", "FALSE"),
        "rows_written": ("count(*)", "FALSE"),
    }
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(CAST({v} AS DOUBLE), 8) AS value, {a} AS alert FROM sc" for m, (v, a) in rows.items()
    )


@query(WITH + f", sc AS (SELECT *, {SCORE_SQL} AS score FROM tset) " + _health_sql())
def serving_health(t: Tables) -> DataFrame:
    scored = stage(tiers.with_risk_tier(demo_scorer(train_rows(t))), "scored")
    return r8(health.serving_health(scored, scored.agg(F.count(F.lit(1))).scalar()), "value")


@query(WITH + """
SELECT 'cohort_size' AS metric, CAST(count(*) AS DOUBLE) AS value, count(*) < 100 AS alert FROM labels03
UNION ALL SELECT 'labels_written', CAST(count(*) AS DOUBLE), FALSE FROM labels03
UNION ALL SELECT 'churn_rate', round(avg(is_churn), 8), avg(is_churn) > 0.5 FROM labels03""")
def labeling_health(t: Tables) -> DataFrame:
    return r8(health.labeling_health(labels.month_labels(t.transactions, MONTH, LABELED)), "value")


# ── model ────────────────────────────────────────────────────────────────────
# A fit has no SQL form; the oracle checks what must hold of any: the scored rows and their
# labels, scores in range, tiers that follow from them, and the features that share the importance.


def _fitted(t: Tables):
    rows = stage(splits.split_3way(train_rows(t), months=TRAIN_MONTHS), "split-features")
    return rows, model.fit_gbt(rows)


@query(WITH + """
SELECT msno, feature_cutoff_date, is_churn, TRUE AS score_in_range, TRUE AS tier_follows FROM tsplit WHERE split = 'test'""")
def gbt_scores(t: Tables) -> DataFrame:
    rows, fitted = _fitted(t)
    scored = tiers.with_risk_tier(model.score(rows.where("split = 'test'"), fitted))
    tier = F.when(F.col("score") >= 0.5, "HIGH").when(F.col("score") >= 0.2, "MED").otherwise("LOW")
    return scored.select(
        "msno", "feature_cutoff_date", "is_churn",
        F.col("score").between(0.0, 1.0).alias("score_in_range"), (F.col("risk_tier") == tier).alias("tier_follows"),
    )


@query(f"SELECT unnest([{', '.join(repr(c) for c in FEATURES)}]) AS feature, TRUE AS not_negative, TRUE AS sums_to_one")
def feature_importance(t: Tables) -> DataFrame:
    rows, fitted = _fitted(t)
    shares = model.feature_importance(fitted, rows)
    total = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9  # one row a feature
    return shares.select("feature", (F.col("importance") >= 0).alias("not_negative"), total.alias("sums_to_one"))


# Two trees are fitted here and in SQL: the second one follows the leaves of the first.
BOOSTING = boosting.Boosting(rounds=2, depth=3, bins=16, step=0.3)
BOOSTED = WITH + boosting_sql(
    FEATURES, CATEGORICAL_FEATURES, BOOSTING.rounds, BOOSTING.depth, BOOSTING.bins, BOOSTING.step, BOOSTING.l2, BOOSTING.min_rows
)


def _boosted(t: Tables):
    rows = stage(splits.split_3way(train_rows(t), months=TRAIN_MONTHS), "split-features")
    return rows, boosting.fit_boosted(rows.where("split <> 'val'"), BOOSTING)


@query(BOOSTED + f"""
SELECT tree, node, name AS feature, CASE WHEN s.feature NOT IN ({", ".join(str(FEATURES.index(c)) for c in CATEGORICAL_FEATURES)}) THEN (
    SELECT e.edge FROM boost_edges e WHERE e.feature = s.feature
    AND (SELECT count(*) FROM boost_edges f WHERE f.feature = s.feature AND f.edge < e.edge) = list_max(s.bins)) END AS cut,
  (SELECT string_agg(CAST(CAST(k.edge AS BIGINT) AS VARCHAR), ',' ORDER BY k.edge) FROM boost_known k WHERE k.feature = s.feature AND list_contains(s.bins, k.bin)) AS left_values,
  missing_left, round(gain, 6) AS gain, CAST(n_left AS BIGINT) AS n_left, CAST(n_right AS BIGINT) AS n_right, round(left_value, 8) AS left_value, round(right_value, 8) AS right_value
FROM boost_splits s""")
def boosted_splits(t: Tables) -> DataFrame:
    """Every split of the fitted trees, with its gain and the values of its children."""
    found = boosting.splits_table(*_boosted(t))
    listed = F.array_join(F.transform("left_values", lambda v: v.cast("bigint").cast("string")), ",")
    return r8(found.withColumns({"left_values": listed, "gain": round_half_away(F.col("gain"), 6)}), "left_value", "right_value")


@query(BOOSTED + """
SELECT msno, feature_cutoff_date, is_churn, round(1.0 / (1.0 + exp(-margin)), 8) AS score FROM boost_margins WHERE split = 'test'""")
def boosted_scores(t: Tables) -> DataFrame:
    """Scores of the test split."""
    rows, fitted = _boosted(t)
    scored = boosting.score_boosted(rows.where("split = 'test'"), fitted)
    return r8(scored.select("msno", "feature_cutoff_date", "is_churn", "score"), "score")


@query(BOOSTED + """
, boost_gain AS (SELECT name, sum(gain) AS gain FROM boost_splits GROUP BY name)
SELECT f.feature, round(coalesce(g.gain, 0) / (SELECT sum(gain) FROM boost_gain), 8) AS importance
FROM (SELECT unnest([""" + ", ".join(repr(c) for c in FEATURES) + """]) AS feature) f LEFT JOIN boost_gain g ON g.name = f.feature""")
def boosted_importance(t: Tables) -> DataFrame:
    """Each feature's share of the gain of all splits."""
    return r8(boosting.gain_shares(*_boosted(t)), "importance")


@query(WITH + """
SELECT msno, feature_cutoff_date, round(1 / (1 + exp(-(coalesce(cancel_rate, 0.5) * 4 - CAST(coalesce(n_txn, 0) AS DOUBLE) / 20))), 8) AS score
FROM tset""")
def opaque_model_scores(t: Tables) -> DataFrame:
    """Any object with ``predict``, here a logistic curve over two features."""

    def load():
        import numpy as np

        class Curve:
            def predict(self, x):
                z = x["cancel_rate"].fillna(0.5) * 4 - x["n_txn"].fillna(0) / 20
                return 1 / (1 + np.exp(-z.to_numpy(dtype=float)))

        return Curve()

    return r8(model.score_with(train_rows(t), load).select("msno", "feature_cutoff_date", "score"), "score")


# ── more of the plans ────────────────────────────────────────────────────────


@query(WITH + """
SELECT msno, scoring_date, score, expiry_date, model_version FROM sub_predictions WHERE msno = '1'
ORDER BY scoring_date DESC LIMIT 1""")
def latest_prediction_of_user(t: Tables) -> DataFrame:
    """The point read of one user."""
    return reads.latest_prediction(t.predictions.drop("rival_score"), user="1")


@query(WITH + SCORED + metrics_sql("hold", "m") + metrics_sql("rival", "c") + "".join(
    f"{' UNION ALL ' if i else ''} SELECT '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, FALSE AS alert FROM c, m"
    for i, (metric, value) in enumerate({
        "test_auc_pr_candidate": "c.auc_pr", "test_auc_roc_candidate": "c.auc_roc", "precision_at_k_candidate": "c.precision_at_k",
        "recall_at_k_candidate": "c.recall_at_k", "test_auc_pr_production": "coalesce(m.auc_pr, 0)",
        "promoted_to_challenger": "CASE WHEN c.auc_pr > m.auc_pr THEN 1 ELSE 0 END",
    }.items())))
def validation_health(t: Tables) -> DataFrame:
    rows = _holdout(t)
    decision = ranking.candidate_decision(rows.withColumn("score", F.col("rival_score")), rows)
    return r8(health.validation_health(decision), "value")


@query(WITH + SCORED + metrics_sql("perf", "m") + """
SELECT *, coalesce(auc_pr < 0.45, FALSE) AS auc_pr_alert, coalesce(auc_pr < 0.45, FALSE) AS retrain FROM m""")
def monthly_performance(t: Tables) -> DataFrame:
    """The monitoring job of one month, over stored labels of several."""
    return r8(run_performance(t.predictions, train_labels(t), MONTH), *_METRICS)


@query(WITH + "SELECT msno, is_churn, anchor_expiry_date FROM tlabels WHERE strftime(anchor_expiry_date, '%Y-%m') IN ('2001-03', '2001-05')")
def labels_by_sql(t: Tables) -> DataFrame:
    """A stored table read by SQL with parameters."""
    train_labels(t).createOrReplaceTempView("stored_labels")
    return read_sql(
        t.spark,
        "SELECT msno, is_churn, anchor_expiry_date FROM stored_labels"
        " WHERE array_contains(:months, date_format(anchor_expiry_date, 'yyyy-MM'))",
        {"months": F.array(F.lit("2001-03"), F.lit("2001-05"))},
    )


@query(WITH + """
, s AS (SELECT p.msno, strftime(p.expiry_date, '%Y-%m') AS month, t.is_churn, p.score, p.rival_score FROM sub_predictions p JOIN sub_train t ON t.msno = p.msno)
, r AS (SELECT 'demo' AS model, month, msno, is_churn, score FROM s UNION ALL SELECT 'rival', month, msno, is_churn, rival_score FROM s)
, g AS (SELECT model, month, score, sum(is_churn) AS tp, sum(1 - is_churn) AS fp FROM r GROUP BY ALL)
, c AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM g WINDOW w AS (PARTITION BY model, month ORDER BY score DESC))
, a AS (SELECT model, month, sum(tp) AS p, sum(fp) AS n, sum(tp * (CAST(ctp AS DOUBLE) / (ctp + cfp))) AS ap,
    sum(fp * (ctp - CAST(tp AS DOUBLE) / 2)) AS auc FROM c GROUP BY ALL)
, k AS (SELECT model, month, avg(is_churn) AS share, sum(is_churn) AS hits FROM (
    SELECT *, row_number() OVER (PARTITION BY model, month ORDER BY score DESC, msno) AS place FROM r) q WHERE place <= 100 GROUP BY ALL)
SELECT model, month, CASE WHEN p > 0 AND n > 0 THEN round(ap / p, 8) END AS auc_pr,
  CASE WHEN p > 0 AND n > 0 THEN round(auc / (CAST(p AS DOUBLE) * n), 8) END AS auc_roc, round(share, 8) AS precision_at_k,
  coalesce(round(CAST(hits AS DOUBLE) / nullif(p, 0), 8), 0.0) AS recall_at_k, CAST(p + n AS BIGINT) AS n_total, CAST(p AS BIGINT) AS n_churned,
  100 AS top_k
FROM a JOIN k USING (model, month)""")
def metrics_by_model_and_month(t: Tables) -> DataFrame:
    """Both models' metrics of every expiry month, in one job."""
    rows = t.predictions.join(t.train.select("msno", "is_churn"), "msno").select(
        "msno", "is_churn", F.date_format("expiry_date", "yyyy-MM").alias("month"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).alias("score")) for m, c in (("demo", "score"), ("rival", "rival_score"))])).alias("s"),
    )
    return r8(ranking.ranking_metrics_by(rows.select("msno", "is_churn", "month", "s.*"), ["model", "month"]), *_METRICS)


@query(WITH + """
, rcohort AS (SELECT DISTINCT msno, expiry_date, CAST(expiry_date - INTERVAL 14 DAY AS DATE) AS feature_cutoff_date
  FROM sub_predictions WHERE scoring_date = DATE '2001-04-17')""" + features_sql("rcohort", "r", "43573.98") + f"""
SELECT m.msno, c.expiry_date, m.feature_cutoff_date, {", ".join(f"m.{c}" for c in FEATURES)}
FROM rmatrix m JOIN rcohort c ON c.msno = m.msno AND c.feature_cutoff_date = m.feature_cutoff_date""")
def features_of_scored_day(t: Tables) -> DataFrame:
    """The features behind the stored scores of a day, rebuilt with the threshold of their dataset version."""
    root = scratch_path(t.spark, "dataset")
    params = t.spark.range(1).select(F.lit(43573.98).alias("p99_secs"), F.lit("v1").alias("dataset_version_id"))
    params.write.parquet(f"{root}/params")
    return features_of_scored(t.predictions, "2001-04-17", t.transactions, t.user_logs, t.members, root, "v1")
