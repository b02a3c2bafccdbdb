"""Cohorts, labels, features, datasets and agreement reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayline.functions.numbers import round_half_away
from stayline.operators import agreement, cohort, drift, features, health, labels, splits
from stayline.operators.pit import staged_cohort
from stayline.plans.dataset import build_dataset, labeled_features
from stayline.schemas import FEATURES
from stayline.session import scratch_path, stage
from stayline.sources import readers, writers
from workload.oracle import FEATURE_LIST, WITH, features_sql, day, psi_sql
from workload.q_profile import stack
from workload.registry import query
from workload.tables import Tables

MONTH, FIRST, LAST = "2001-03", 20010301, 20010331
FIRST_MONTH, LAST_MONTH = "1995-01", "2001-08"  # all months whose renewals are known
LAST_CUTOFF = 20010817
TRAIN_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8)]
LABELED = "2001-05-01"


def train_cohort(t: Tables) -> DataFrame:
    return cohort.monthly_cohorts(t.transactions, FIRST_MONTH, LAST_MONTH)


def train_labels(t: Tables) -> DataFrame:
    bounds = labels.window_bounds(FIRST_MONTH, LAST_MONTH)
    return labels.churn_labels(train_cohort(t), t.transactions, "2001-09-30", bounds=bounds)


def train_rows(t: Tables) -> DataFrame:
    """Labeled features of all cohort months; the label table is stored first, as in a real run."""
    stored = staged_cohort(train_labels(t))
    return labeled_features(stored, t.transactions, t.user_logs, t.members, None, LAST_CUTOFF)


# ── cohorts and labels ───────────────────────────────────────────────────────


@query(WITH + "SELECT * FROM cohort")
def label_cohort(t: Tables) -> DataFrame:
    return cohort.label_cohort(t.transactions, MONTH)


@query(WITH + "SELECT * FROM cohort_raw")
def label_cohort_backdated(t: Tables) -> DataFrame:
    return cohort.label_cohort(t.transactions, MONTH, drop_backdated=False)


@query(WITH + "SELECT * FROM tcohort")
def monthly_cohorts(t: Tables) -> DataFrame:
    return train_cohort(t)


@query(WITH + "SELECT * FROM labels03")
def churn_labels(t: Tables) -> DataFrame:
    return labels.month_labels(t.transactions, MONTH, LABELED)


@query(WITH + "SELECT * FROM tlabels")
def churn_labels_by_month(t: Tables) -> DataFrame:
    return train_labels(t)


@query(WITH + "SELECT msno FROM labels03 WHERE is_churn = 0")
def renewed_users(t: Tables) -> DataFrame:
    bounds = labels.window_bounds(MONTH, MONTH)
    return labels.renewed_users(cohort.label_cohort(t.transactions, MONTH), t.transactions, bounds=bounds)


@query(WITH + """
SELECT count(*) AS total, CAST(sum(is_churn) AS BIGINT) AS churned, CAST(count(*) - sum(is_churn) AS BIGINT) AS retained,
  round(100.0 * sum(is_churn) / count(*), 4) AS churn_rate_pct FROM labels03""")
def churn_rate(t: Tables) -> DataFrame:
    return labels.churn_rate(labels.month_labels(t.transactions, MONTH, LABELED))


@query(WITH + """
SELECT count(*) AS total, CAST(sum(is_churn) AS BIGINT) AS churned, CAST(count(*) - sum(is_churn) AS BIGINT) AS retained,
  round(100.0 * sum(is_churn) / count(*), 4) AS churn_rate_pct FROM sub_train""")
def official_churn_rate(t: Tables) -> DataFrame:
    return labels.churn_rate(t.train)


@query(WITH + """
SELECT DISTINCT msno, DATE '2001-03-15' AS expiry_date FROM sub_transactions
WHERE membership_expire_date = 20010315 AND membership_expire_date >= transaction_date""")
def expiring_cohort(t: Tables) -> DataFrame:
    return cohort.expiring_cohort(t.transactions, "2001-03-01")


@query(WITH + """
SELECT msno, anchor_expiry_date, is_churn FROM tlabels
WHERE strftime(anchor_expiry_date, '%Y-%m') IN ('2001-04', '2001-06')""")
def labels_for_months(t: Tables) -> DataFrame:
    return labels.labels_for_months(train_labels(t), ["2001-04", "2001-06"])


@query(WITH + """
SELECT count(*) FILTER (WHERE is_churn = 0) AS n_negative, count(*) FILTER (WHERE is_churn = 1) AS n_positive,
  round(CAST(count(*) FILTER (WHERE is_churn = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE is_churn = 1), 1), 8) AS scale_pos_weight
FROM sub_train""")
def class_ratio(t: Tables) -> DataFrame:
    return labels.class_ratio(t.train).withColumn("scale_pos_weight", round_half_away(F.col("scale_pos_weight"), 8))


# ── overlap and agreement ────────────────────────────────────────────────────


@query(WITH + """
SELECT count(*) AS total_cohort,
  count(*) FILTER (WHERE anchor_expiry_date + 30 > DATE '2001-03-31') AS window_past_data_end,
  round(100.0 * count(*) FILTER (WHERE anchor_expiry_date + 30 > DATE '2001-03-31') / count(*), 2) AS pct_unverifiable
FROM cohort_raw""")
def unverifiable_share(t: Tables) -> DataFrame:
    anchored = cohort.label_cohort(t.transactions, MONTH, drop_backdated=False)
    return agreement.unverifiable_share(anchored, "2001-03-31")


@query(WITH + f"""
, h AS (SELECT c.msno, EXISTS (SELECT 1 FROM sub_user_logs l WHERE l.msno = c.msno
    AND {day('l.date')} <= c.feature_cutoff_date) AS has_log FROM tcohort c)
SELECT count(*) AS anchored_users, count(*) FILTER (WHERE has_log) AS with_log_data,
  count(*) FILTER (WHERE NOT has_log) AS without_log_data FROM h""")
def log_coverage(t: Tables) -> DataFrame:
    return agreement.log_coverage(train_cohort(t), t.user_logs, LAST_CUTOFF)


@query(WITH + """
SELECT count(*) AS no_txn_match FROM sub_train t LEFT JOIN (SELECT DISTINCT msno FROM sub_transactions) x ON x.msno = t.msno
WHERE x.msno IS NULL""")
def users_without_txn(t: Tables) -> DataFrame:
    return agreement.users_without(t.train, t.transactions, "no_txn_match")


@query(WITH + """
SELECT 'in_train_not_derived' AS side, count(*) AS n_users FROM sub_train t WHERE NOT EXISTS (SELECT 1 FROM labels03_raw d WHERE d.msno = t.msno)
UNION ALL
SELECT 'in_derived_not_train', count(*) FROM labels03_raw d WHERE NOT EXISTS (SELECT 1 FROM sub_train t WHERE d.msno = t.msno)""")
def cohort_miss(t: Tables) -> DataFrame:
    derived = labels.month_labels(t.transactions, MONTH, LABELED, drop_backdated=False)
    return agreement.cohort_miss(derived, t.train)


@query(WITH + """
SELECT count(DISTINCT c.msno) AS cohort_users, count(DISTINCT CASE WHEN t.msno IS NOT NULL THEN c.msno END) AS in_train,
  count(DISTINCT CASE WHEN t.msno IS NULL THEN c.msno END) AS not_in_train
FROM cohort_raw c LEFT JOIN sub_train t ON t.msno = c.msno""")
def cohort_overlap(t: Tables) -> DataFrame:
    return agreement.cohort_overlap(cohort.label_cohort(t.transactions, MONTH, drop_backdated=False), t.train)


@query(WITH + """
, a AS (SELECT count(*) AS n, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM sub_transactions x WHERE x.msno = t.msno
  AND x.membership_expire_date BETWEEN 20010301 AND 20010331)) AS h FROM sub_train t)
SELECT n AS train_total_users, h AS users_with_anchor, n - h AS users_missing_anchor, round(100.0 * h / n, 2) AS pct_covered FROM a""")
def anchor_gap(t: Tables) -> DataFrame:
    return agreement.anchor_gap(t.train, t.transactions, FIRST, LAST)


def _agreement_sql(relation: str, cohort_name: str, label: str) -> str:
    return f"""
SELECT '{label}' AS cohort, (SELECT count(*) FROM {cohort_name}) AS cohort_users, count(*) AS labelled_users,
  round(100.0 * count(*) / (SELECT count(*) FROM {cohort_name}), 2) AS labelled_pct,
  round(100.0 * sum(CASE WHEN d.is_churn = t.is_churn THEN 1 ELSE 0 END) / count(*), 2) AS agreeing_pct
FROM {relation} d JOIN sub_train t ON t.msno = d.msno"""


@query(WITH + _agreement_sql("labels02_raw", "cohort_feb_raw", "2001-02 expiry") + " UNION ALL " + _agreement_sql("labels03_raw", "cohort_raw", "2001-03 expiry"))
def cohort_agreement(t: Tables) -> DataFrame:
    reports = [(20010201, 20010228, "2001-02 expiry"), (FIRST, LAST, "2001-03 expiry")]
    return stack([agreement.cohort_agreement(t.train, t.transactions, *r) for r in reports])


@query(WITH + """
SELECT derived, official, users, agrees, round(100.0 * users / sum(users) OVER (), 4) AS share_pct,
  round(100.0 * users / sum(users) OVER (PARTITION BY derived), 4) AS row_pct
FROM (SELECT d.is_churn AS derived, t.is_churn AS official, d.is_churn = t.is_churn AS agrees, count(*) AS users
  FROM labels03_raw d JOIN sub_train t ON t.msno = d.msno GROUP BY ALL) q""")
def label_agreement(t: Tables) -> DataFrame:
    derived = labels.month_labels(t.transactions, MONTH, LABELED, drop_backdated=False)
    return agreement.label_agreement(derived, t.train)


@query(WITH + """
SELECT k.kind, l.* FROM labels03 l, (VALUES ('csv'), ('parquet')) AS k(kind)""")
def labels_by_source_kind(t: Tables) -> DataFrame:
    """The month's labels from transactions kept as CSV and as Parquet, through the one loader."""
    root = scratch_path(t.spark, "sources")
    writers.write_csv(t.transactions, f"{root}/csv/{readers.CSV_FILES['transactions']}")
    t.transactions.write.parquet(f"{root}/parquet/transactions")
    kinds = []
    for kind in ("csv", "parquet"):
        txn = readers.load_sources(t.spark, kind, f"{root}/{kind}", ("transactions",))["transactions"]
        kinds.append(labels.month_labels(txn, MONTH, LABELED).select(F.lit(kind).alias("kind"), "*"))
    return kinds[0].unionByName(kinds[1])


LATEST = """
, latest AS (
  SELECT DISTINCT ON (x.msno) x.* FROM sub_transactions x SEMI JOIN sub_train USING (msno)
  ORDER BY x.msno, x.transaction_date DESC, x.membership_expire_date DESC, x.payment_method_id DESC, x.payment_plan_days DESC,
    x.plan_list_price DESC, x.actual_amount_paid DESC, x.is_auto_renew DESC, x.is_cancel DESC)
, placed AS (
  SELECT l.*, coalesce(m.bucket, 'elsewhere') AS bucket FROM latest l LEFT JOIN (VALUES
    (200103, 'anchor:2001-03'), (200104, 'later:2001-04'), (200105, 'later:2001-05')) m(month, bucket)
    ON m.month = l.membership_expire_date // 100)
"""


@query(WITH + LATEST + "SELECT * FROM latest")
def latest_transaction(t: Tables) -> DataFrame:
    return cohort.latest_transaction(t.transactions, t.train)


@query(WITH + LATEST + "SELECT bucket, count(*) AS users FROM placed GROUP BY 1")
def expiry_buckets(t: Tables) -> DataFrame:
    return agreement.expiry_buckets(t.train, t.transactions, MONTH, ["2001-04", "2001-05"])


@query(WITH + LATEST + """
SELECT bucket, count(*) AS users, median(payment_plan_days) AS median_plan_days, round(avg(payment_plan_days), 1) AS avg_plan_days,
  min(transaction_date) AS min_txn_date, max(transaction_date) AS max_txn_date FROM placed WHERE bucket <> 'elsewhere' GROUP BY 1""")
def plan_days_by_bucket(t: Tables) -> DataFrame:
    return agreement.plan_days_by_bucket(t.train, t.transactions, MONTH, ["2001-04", "2001-05"])


@query(WITH + """
, ends AS (SELECT msno, max(membership_expire_date) // 100 AS m, max(membership_expire_date) AS d FROM sub_transactions GROUP BY msno)
, out_of_month AS (SELECT t.msno, ends.m FROM sub_train t LEFT JOIN ends USING (msno)
    WHERE NOT EXISTS (SELECT 1 FROM ends e WHERE e.msno = t.msno AND e.d >= 20010301 AND e.d <= 20010331))
SELECT coalesce(CAST(m AS VARCHAR), 'never') AS last_expiry_month, count(*) AS users,
  round(100.0 * count(*) / (SELECT count(*) FROM out_of_month), 2) AS share_pct
FROM out_of_month GROUP BY m ORDER BY users DESC, last_expiry_month LIMIT 15""")
def latest_expiry_months(t: Tables) -> DataFrame:
    return agreement.latest_expiry_months(t.train, t.transactions, FIRST, LAST, n=15)


@query(WITH + """
, active AS (SELECT DISTINCT msno FROM sub_transactions WHERE is_cancel = 0 AND membership_expire_date >= 20010201)
SELECT (SELECT count(*) FROM active) AS active_users,
  (SELECT count(*) FROM active SEMI JOIN sub_train USING (msno)) AS labelled,
  (SELECT count(*) FROM active ANTI JOIN sub_train USING (msno)) AS unlabelled""")
def recent_active_users(t: Tables) -> DataFrame:
    return agreement.recent_active_users(t.transactions, t.train, 20010201)


@query(WITH + f"""
SELECT t.msno, t.is_churn, {day('max(x.membership_expire_date)')} AS anchor_expiry_date,
  CAST({day('max(x.membership_expire_date)')} - 14 AS DATE) AS feature_cutoff_date
FROM sub_train t JOIN sub_transactions x ON x.msno = t.msno AND x.membership_expire_date BETWEEN 20010301 AND 20010331
GROUP BY 1, 2""")
def anchored_training_cohort(t: Tables) -> DataFrame:
    return cohort.labeled_anchors(t.train, t.transactions, FIRST, LAST)


# ── features ─────────────────────────────────────────────────────────────────


@query(WITH + "SELECT CAST(p99_secs AS DOUBLE) AS p99_secs FROM tp99")
def p99_secs(t: Tables) -> DataFrame:
    users = staged_cohort(train_cohort(t))
    return features.p99_secs(t.user_logs, users, LAST_CUTOFF)


@query(WITH + """
SELECT msno, date, least(total_secs, 86400, (SELECT p99_secs FROM tp99)) AS total_secs_w FROM sub_user_logs""")
def winsorized_logs(t: Tables) -> DataFrame:
    users = staged_cohort(train_cohort(t))
    p99 = features.p99_secs(t.user_logs, users, LAST_CUTOFF).scalar()
    return t.user_logs.select("msno", "date", features.winsorized_secs(p99).alias("total_secs_w"))


@query(WITH + "SELECT * FROM ttxn")
def features_txn(t: Tables) -> DataFrame:
    users = staged_cohort(train_cohort(t))
    return features.txn_features(t.transactions, users, last_cutoff=LAST_CUTOFF)


@query(WITH + "SELECT * FROM ttxn")
def features_txn_shuffled(t: Tables) -> DataFrame:
    """The same features with both sides of the join shuffled, as for a cohort too large to broadcast."""
    return features.txn_features(t.transactions, staged_cohort(train_cohort(t)), last_cutoff=LAST_CUTOFF, hint="merge")


@query(WITH + "SELECT * FROM tlog")
def features_log(t: Tables) -> DataFrame:
    users = staged_cohort(train_cohort(t))
    p99 = features.p99_secs(t.user_logs, users, LAST_CUTOFF).scalar()
    return features.log_features(t.user_logs, users, p99, last_cutoff=LAST_CUTOFF)


@query(WITH + "SELECT * FROM tmem")
def features_member(t: Tables) -> DataFrame:
    return features.member_features(t.members, train_cohort(t))


@query(WITH + f"SELECT msno, feature_cutoff_date, {FEATURE_LIST} FROM tmatrix")
def feature_matrix(t: Tables) -> DataFrame:
    users = staged_cohort(train_cohort(t).select("msno", "feature_cutoff_date"))
    p99 = features.p99_secs(t.user_logs, users, LAST_CUTOFF).scalar()
    return features.feature_matrix(users, t.transactions, t.user_logs, t.members, p99, LAST_CUTOFF)


@query(WITH + "SELECT * FROM tset")
def training_set(t: Tables) -> DataFrame:
    return train_rows(t)


OFFICIAL = f"""
, ocohort AS (SELECT t.msno, t.is_churn, {day('max(x.membership_expire_date)')} AS anchor_expiry_date,
    CAST({day('max(x.membership_expire_date)')} - 14 AS DATE) AS feature_cutoff_date
  FROM sub_train t JOIN sub_transactions x ON x.msno = t.msno AND x.membership_expire_date BETWEEN 20010301 AND 20010331
  GROUP BY 1, 2)
, op99 AS (SELECT quantile_cont(least(total_secs, 86400), 0.99) AS p FROM sub_user_logs)
"""


@query(WITH + OFFICIAL + features_sql("ocohort", "o", "(SELECT p FROM op99)") + f"""
SELECT m.msno, m.feature_cutoff_date, {FEATURE_LIST}, c.is_churn, strftime(c.anchor_expiry_date, '%Y-%m') AS cohort_month,
  CAST(CASE WHEN log_days IS NULL THEN 0 ELSE 1 END AS TINYINT) AS has_log_data
FROM omatrix m JOIN ocohort c ON c.msno = m.msno""")
def official_training_set(t: Tables) -> DataFrame:
    """Officially labeled users with a verified anchor, one global threshold, backdated anchors kept."""
    anchored = staged_cohort(cohort.labeled_anchors(t.train, t.transactions, FIRST, LAST))
    p99 = features.p99_secs(t.user_logs).scalar()
    users = anchored.select("msno", "feature_cutoff_date")
    matrix = features.feature_matrix(users, t.transactions, t.user_logs, t.members, p99, 20010317)
    return features.attach_labels(anchored, matrix)


GROUP_SQL = """CASE WHEN feature IN ('n_txn','n_cancel','ever_cancelled','ever_promo','last_is_auto_renew','last_is_cancel',
  'last_actual_amount_paid','last_payment_plan_days','last_plan_list_price','last_discount','cancel_rate','days_since_last_txn')
  THEN 'transaction' WHEN feature IN ('registered_via','tenure_days') THEN 'member' ELSE 'usage' END"""


@query(WITH + ", n AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS r FROM tset" for c in FEATURES
) + f") SELECT feature, round(r, 8) AS null_rate, {GROUP_SQL} AS feature_group FROM n")
def feature_null_rates(t: Tables) -> DataFrame:
    return features.null_rates(train_rows(t)).withColumn("null_rate", round_half_away(F.col("null_rate"), 8))


# ── splits and datasets ──────────────────────────────────────────────────────


@query(WITH + "SELECT msno, feature_cutoff_date, split FROM tsplit")
def split_3way(t: Tables) -> DataFrame:
    rows = train_labels(t).withColumn("cohort_month", F.date_format("anchor_expiry_date", "yyyy-MM"))
    return splits.split_3way(rows).select("msno", "feature_cutoff_date", "split")


@query(WITH + """
SELECT msno, feature_cutoff_date, CASE WHEN cohort_month = '2001-08' THEN 'val' ELSE 'train' END AS split FROM tset""")
def split_2way(t: Tables) -> DataFrame:
    rows = train_labels(t).withColumn("cohort_month", F.date_format("anchor_expiry_date", "yyyy-MM"))
    return splits.split_2way(rows).select("msno", "feature_cutoff_date", "split")


@query(WITH + """
SELECT msno, is_churn, CASE WHEN substr(md5(msno || '|42'), 1, 8) < '26666666' THEN 'test'
  WHEN substr(md5(msno || '|42'), 1, 8) < '4ccccccc' THEN 'val' ELSE 'train' END AS split FROM sub_train""")
def split_random(t: Tables) -> DataFrame:
    return splits.split_3way(t.train).select("msno", "is_churn", "split")


@query(WITH + """
SELECT split, count(*) AS n, CAST(sum(is_churn) AS BIGINT) AS churned, round(avg(is_churn), 8) AS churn_rate FROM tsplit GROUP BY 1""")
def split_summary(t: Tables) -> DataFrame:
    rows = train_labels(t).withColumn("cohort_month", F.date_format("anchor_expiry_date", "yyyy-MM"))
    return health.split_summary(splits.split_3way(rows)).withColumn("churn_rate", round_half_away(F.col("churn_rate"), 8))


@query(WITH + f"SELECT msno, {FEATURE_LIST} FROM tsplit WHERE split <> 'test'")
def drift_baseline(t: Tables) -> DataFrame:
    rows = splits.split_3way(stage(train_rows(t), "features"))
    return rows.where(F.col("split").isin("train", "val")).select("msno", *FEATURES)


@query(WITH + f"SELECT split, (SELECT round(p99_secs, 6) FROM tp99) AS p99_secs, msno, {FEATURE_LIST}, is_churn, cohort_month, has_log_data FROM tsplit")
def dataset_roundtrip(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "dataset")
    build_dataset(train_labels(t), t.transactions, t.user_logs, t.members, root, "v1")
    p99 = readers.dataset_params(t.spark, root, "v1").select("p99_secs").scalar()
    parts = [
        readers.dataset_split(t.spark, root, "v1", s).withColumn("split", F.lit(s)) for s in ("train", "val", "test")
    ]
    return stack(parts).select(
        "split", p99.alias("p99_secs"), "msno", *FEATURES, "is_churn", "cohort_month", "has_log_data"
    )


# ── drift ────────────────────────────────────────────────────────────────────


def drift_of(t: Tables, columns: list[str]) -> DataFrame:
    # As a dataset version does: split features and the baseline's histograms are stored.
    rows = stage(splits.split_3way(train_rows(t), months=TRAIN_MONTHS), "split-features")
    stored = stage(drift.histograms(rows.where("split <> 'test'"), columns), "histograms")
    psi = drift.drift_from(stored, rows.where("split = 'test'"), columns)
    return psi.withColumn("psi", round_half_away(F.col("psi"), 8))


@query(WITH + psi_sql(["tenure_days"]) + "SELECT * FROM psi")
def psi_single(t: Tables) -> DataFrame:
    return drift_of(t, ["tenure_days"])


@query(WITH + psi_sql(FEATURES) + "SELECT * FROM psi")
def feature_drift(t: Tables) -> DataFrame:
    return drift_of(t, FEATURES)


@query(WITH + psi_sql(FEATURES) + """
SELECT count(*) FILTER (WHERE psi > 0.2) AS n_drifted_features,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE psi > 0.2), '') AS drifted_features FROM psi""")
def drift_alerts(t: Tables) -> DataFrame:
    return drift.drift_alerts(drift_of(t, FEATURES))
