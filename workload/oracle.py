"""Shared SQL in front of every oracle query: the adapter views, then naive versions of the
main operators (nested loops of EXISTS, row_number, percentile_cont), written for clarity."""

from __future__ import annotations

from stayline.schemas import FEATURES
from workload.tables import SQL


def day(x: str) -> str:
    return f"CAST(strptime(CAST({x} AS VARCHAR), '%Y%m%d') AS DATE)"


def features_sql(cohort: str, prefix: str, p99: str) -> str:
    """Feature tables of a cohort relation (msno, feature_cutoff_date)."""
    return f"""
, {prefix}txn0 AS (
  SELECT c.msno, c.feature_cutoff_date, {day('t.transaction_date')} AS txn_dt, t.*  EXCLUDE (msno),
    t.payment_plan_days = 0 AND t.plan_list_price = 0 AND t.actual_amount_paid > 0 AS is_legacy
  FROM {cohort} c JOIN sub_transactions t ON t.msno = c.msno
  WHERE t.membership_expire_date >= t.transaction_date
    AND {day('t.transaction_date')} <= c.feature_cutoff_date
), {prefix}txn1 AS (
  SELECT *, row_number() OVER (PARTITION BY msno, feature_cutoff_date ORDER BY txn_dt DESC,
      membership_expire_date DESC, actual_amount_paid DESC, payment_plan_days DESC,
      plan_list_price DESC, is_auto_renew DESC, is_cancel DESC) AS rn
  FROM {prefix}txn0
), {prefix}txn AS (
  SELECT msno, feature_cutoff_date,
    count(*) AS n_txn,
    CAST(sum(is_cancel) AS BIGINT) AS n_cancel,
    CAST(max(is_cancel) AS INT) AS ever_cancelled,
    CAST(max(CASE WHEN actual_amount_paid = 0 THEN 1 ELSE 0 END) AS INT) AS ever_promo,
    CAST(max(CASE WHEN rn = 1 THEN is_auto_renew END) AS INT) AS last_is_auto_renew,
    CAST(max(CASE WHEN rn = 1 THEN is_cancel END) AS INT) AS last_is_cancel,
    max(CASE WHEN rn = 1 AND NOT is_legacy THEN actual_amount_paid END) AS last_actual_amount_paid,
    CAST(max(CASE WHEN rn = 1 AND NOT is_legacy THEN payment_plan_days END) AS INT) AS last_payment_plan_days,
    max(CASE WHEN rn = 1 AND NOT is_legacy THEN plan_list_price END) AS last_plan_list_price,
    max(CASE WHEN rn = 1 AND NOT is_legacy THEN plan_list_price - actual_amount_paid END) AS last_discount,
    round(CAST(sum(is_cancel) AS DOUBLE) / count(*), 4) AS cancel_rate,
    CAST(date_diff('day', max(txn_dt), feature_cutoff_date) AS INT) AS days_since_last_txn
  FROM {prefix}txn1 GROUP BY msno, feature_cutoff_date
), {prefix}log0 AS (
  SELECT c.msno, c.feature_cutoff_date, {day('l.date')} AS log_dt, l.* EXCLUDE (msno, date),
    l.num_25 + l.num_50 + l.num_75 + l.num_985 + l.num_100 AS plays
  FROM {cohort} c JOIN sub_user_logs l ON l.msno = c.msno
  WHERE {day('l.date')} <= c.feature_cutoff_date
), {prefix}log AS (
  SELECT msno, feature_cutoff_date,
    count(*) AS log_days,
    round(avg(least(total_secs, 86400, {p99})), 1) AS avg_daily_secs,
    round(sum(least(total_secs, 86400, {p99})), 0) AS total_secs_sum,
    round(avg(CAST(num_100 AS DOUBLE) / nullif(plays, 0)), 4) AS avg_completion_ratio,
    round(avg(CAST(num_unq AS DOUBLE)), 2) AS avg_daily_unq_songs,
    CAST(date_diff('day', max(log_dt), feature_cutoff_date) AS INT) AS days_since_last_log
  FROM {prefix}log0 GROUP BY msno, feature_cutoff_date
), {prefix}mem AS (
  SELECT c.msno, c.feature_cutoff_date, CAST(m.registered_via AS INT) AS registered_via,
    CAST(date_diff('day', {day('m.registration_init_time')}, c.feature_cutoff_date) AS INT) AS tenure_days
  FROM {cohort} c JOIN sub_members m ON m.msno = c.msno
  WHERE {day('m.registration_init_time')} BETWEEN DATE '2000-01-01' AND c.feature_cutoff_date
), {prefix}matrix AS (
  SELECT c.msno, c.feature_cutoff_date, t.* EXCLUDE (msno, feature_cutoff_date),
    l.* EXCLUDE (msno, feature_cutoff_date), m.* EXCLUDE (msno, feature_cutoff_date)
  FROM {cohort} c
  LEFT JOIN {prefix}txn t ON t.msno = c.msno AND t.feature_cutoff_date = c.feature_cutoff_date
  LEFT JOIN {prefix}log l ON l.msno = c.msno AND l.feature_cutoff_date = c.feature_cutoff_date
  LEFT JOIN {prefix}mem m ON m.msno = c.msno AND m.feature_cutoff_date = c.feature_cutoff_date
)"""


def _cohort(name: str, first: int, last: int, valid: bool = True, by_month: bool = False) -> str:
    keep = "AND membership_expire_date >= transaction_date" if valid else ""
    month = ", membership_expire_date // 100" if by_month else ""
    return f"""
, {name} AS (
  SELECT msno, {day('max(membership_expire_date)')} AS anchor_expiry_date,
    CAST({day('max(membership_expire_date)')} - 14 AS DATE) AS feature_cutoff_date
  FROM sub_transactions
  WHERE membership_expire_date BETWEEN {first} AND {last} {keep}
  GROUP BY msno{month}
)"""


def _labels(name: str, cohort: str, labeled: str, window: int = 30, valid: bool = True) -> str:
    keep = "AND t.membership_expire_date >= t.transaction_date" if valid else ""
    return f"""
, {name} AS (
  SELECT c.msno, c.anchor_expiry_date, c.feature_cutoff_date,
    CAST(CASE WHEN r.msno IS NULL THEN 1 ELSE 0 END AS SMALLINT) AS is_churn,
    DATE '{labeled}' AS labeled_date
  FROM {cohort} c LEFT JOIN (
    SELECT DISTINCT c.msno, c.anchor_expiry_date
    FROM {cohort} c JOIN sub_transactions t ON t.msno = c.msno
    WHERE t.is_cancel = 0 {keep}
      AND {day('t.transaction_date')} > c.anchor_expiry_date
      AND {day('t.transaction_date')} <= CAST(c.anchor_expiry_date + {window} AS DATE)
  ) r ON r.msno = c.msno AND r.anchor_expiry_date = c.anchor_expiry_date
)"""


WITH = (
    SQL
    + _cohort("cohort", 20010301, 20010331)
    + _cohort("cohort_raw", 20010301, 20010331, valid=False)
    + _cohort("cohort_feb_raw", 20010201, 20010228, valid=False)
    + _cohort("tcohort", 19950101, 20010831, by_month=True)
    + _labels("labels03", "cohort", "2001-05-01")
    + _labels("labels03_raw", "cohort_raw", "2001-05-01", valid=False)
    + _labels("labels02_raw", "cohort_feb_raw", "2001-05-01", valid=False)
    + _labels("tlabels", "tcohort", "2001-09-30")
    + f"""
, tp99 AS (
  SELECT coalesce(quantile_cont(least(l.total_secs, 86400), 0.99), 86400.0) AS p99_secs
  FROM tcohort c JOIN sub_user_logs l ON l.msno = c.msno
  WHERE {day('l.date')} <= c.feature_cutoff_date
)"""
    + features_sql("tcohort", "t", "(SELECT p99_secs FROM tp99)")
    + """
, tset AS (
  SELECT m.*, l.is_churn, strftime(l.anchor_expiry_date, '%Y-%m') AS cohort_month,
    CAST(CASE WHEN m.log_days IS NULL THEN 0 ELSE 1 END AS TINYINT) AS has_log_data
  FROM tmatrix m JOIN tlabels l ON l.msno = m.msno AND l.feature_cutoff_date = m.feature_cutoff_date
), tsplit AS (
  SELECT *, CASE WHEN cohort_month = '2001-08' THEN 'test' WHEN cohort_month = '2001-07' THEN 'val'
                 ELSE 'train' END AS split
  FROM tset
)"""
)

FEATURE_LIST = ", ".join(FEATURES)


def long(relation: str, columns: list[str], where: str = "TRUE", name: str = "feature") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, CAST({c} AS DOUBLE) AS x FROM {relation} WHERE {where}" for c in columns
    )


def psi_sql(columns: list[str]) -> str:
    """Naive PSI: every value against every bin of its feature."""
    return f"""
, pb AS ({long('tsplit', columns, "split <> 'test'")})
, pc AS ({long('tsplit', columns, "split = 'test'")})
, pr AS (SELECT feature, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
          CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM pb WHERE x IS NOT NULL GROUP BY 1)
, pe AS (SELECT feature, i, lo + i * ((hi - lo) / 10.0) AS e0,
          CASE WHEN i = 9 THEN CAST('inf' AS DOUBLE) ELSE lo + (i + 1) * ((hi - lo) / 10.0) END AS e1
         FROM pr, (SELECT CAST(range AS DOUBLE) AS i FROM range(10)) r)
, ps AS (SELECT e.feature, e.i,
    (SELECT count(*) FROM pb WHERE pb.feature = e.feature AND x >= e0 AND x < e1) AS nb,
    (SELECT count(*) FROM pc WHERE pc.feature = e.feature AND x >= e0 AND x < e1) AS nc
  FROM pe e)
, pt AS (SELECT f.feature, (SELECT count(x) FROM pb WHERE pb.feature = f.feature) AS tb,
    (SELECT count(x) FROM pc WHERE pc.feature = f.feature) AS tc
  FROM (SELECT unnest([{', '.join(f"'{c}'" for c in columns)}]) AS feature) f)
, pshare AS (SELECT ps.feature,
    CASE WHEN nb = 0 THEN 1e-4 ELSE CAST(nb AS DOUBLE) / tb END AS b,
    CASE WHEN nc = 0 THEN 1e-4 ELSE CAST(nc AS DOUBLE) / tc END AS c
  FROM ps JOIN pt ON pt.feature = ps.feature WHERE tb > 0 AND tc > 0)
, psi AS (SELECT pt.feature, round(coalesce((SELECT sum((c - b) * ln(c / b)) FROM pshare s
    WHERE s.feature = pt.feature), 0.0), 8) AS psi FROM pt)
"""


def metrics_sql(scored: str, name: str, k: int = 100) -> str:
    """Average precision and ROC area by cumulative counts over distinct scores."""
    return f"""
, {name}_g AS (SELECT score, sum(is_churn) AS tp, sum(1 - is_churn) AS fp FROM {scored} GROUP BY score)
, {name}_c AS (SELECT *, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp FROM {name}_g)
, {name}_a AS (SELECT sum(tp) AS p, sum(fp) AS n,
    sum(tp * (CAST(ctp AS DOUBLE) / (ctp + cfp))) AS ap, sum(fp * (ctp - CAST(tp AS DOUBLE) / 2)) AS auc FROM {name}_c)
, {name}_k AS (SELECT * FROM {scored} ORDER BY score DESC, msno LIMIT {k})
, {name} AS (SELECT
    CASE WHEN p > 0 AND n > 0 THEN round(ap / p, 8) END AS auc_pr,
    CASE WHEN p > 0 AND n > 0 THEN round(auc / (CAST(p AS DOUBLE) * n), 8) END AS auc_roc,
    (SELECT round(avg(is_churn), 8) FROM {name}_k) AS precision_at_k,
    coalesce(round(CAST((SELECT sum(is_churn) FROM {name}_k) AS DOUBLE) / nullif(p, 0), 8), 0.0) AS recall_at_k,
    CAST(p + n AS BIGINT) AS n_total, CAST(p AS BIGINT) AS n_churned, {k} AS top_k
  FROM {name}_a)
"""


def boosting_sql(features: list[str], categories: list[str], rounds: int, depth: int, bins: int, step: float, l2: float, least: int) -> str:
    """Boosted trees over ``tsplit``, level by level: every split is a relation, ``boost_splits``; ``boost_margins`` has the sums of leaves."""
    unit, known = 1 << 20, ", ".join(str(i) for i, c in enumerate(features) if c in categories)
    values = " UNION ALL ".join(f"SELECT rid, split, {i} AS feature, CAST({c} AS DOUBLE) AS x FROM boost_rows" for i, c in enumerate(features))
    names = "CASE feature " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(features)) + " END"
    out = f"""
, boost_rows AS MATERIALIZED (SELECT row_number() OVER (ORDER BY msno, feature_cutoff_date) AS rid, * FROM tsplit)
, boost_values AS MATERIALIZED ({values})
, boost_counts AS (SELECT feature, x, count(*) AS c FROM boost_values WHERE split = 'train' AND x IS NOT NULL GROUP BY ALL)
, boost_running AS (SELECT *, sum(c) OVER (PARTITION BY feature ORDER BY x) AS upto, sum(c) OVER (PARTITION BY feature) AS n FROM boost_counts)
, boost_edges AS MATERIALIZED (SELECT feature, x AS edge FROM boost_running WHERE feature NOT IN ({known}) AND upto < n
    AND (upto * {bins}) // n > ((upto - c) * {bins}) // n)
, boost_known AS MATERIALIZED (SELECT feature, x AS edge, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS bin FROM boost_counts WHERE feature IN ({known}))
, boost_bins AS MATERIALIZED (
  SELECT v.rid, v.feature, CASE WHEN any_value(v.x) IS NULL THEN -1 ELSE count(e.edge) END AS bin
  FROM boost_values v LEFT JOIN boost_edges e ON e.feature = v.feature AND e.edge < v.x WHERE v.feature NOT IN ({known}) GROUP BY v.rid, v.feature
  UNION ALL SELECT v.rid, v.feature, coalesce(k.bin, -1) FROM boost_values v LEFT JOIN boost_known k ON k.feature = v.feature AND k.edge = v.x
  WHERE v.feature IN ({known}))
, boost_weight AS (SELECT CAST(count(*) FILTER (WHERE is_churn = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE is_churn = 1), 1) AS w
  FROM tsplit WHERE split = 'train')
, boost_margins0 AS (SELECT rid, split, is_churn AS y, CAST(0 AS DOUBLE) AS margin FROM boost_rows)"""
    splits = []
    for r in range(rounds):
        out += f"""
, boost_g{r} AS MATERIALIZED (
  SELECT rid, CAST(floor((p - y) * wy * {unit}.0 + 0.5) AS BIGINT) AS g, CAST(floor(p * (1.0 - p) * wy * {unit}.0 + 0.5) AS BIGINT) AS h
  FROM (SELECT rid, y, 1.0 / (1.0 + exp(-margin)) AS p, CASE WHEN y = 1 THEN w ELSE 1.0 END AS wy FROM boost_margins{r}, boost_weight WHERE split = 'train') q)
, boost_at{r}_0 AS (SELECT rid, 1 AS node FROM boost_rows)"""
        for level in range(depth):
            s = f"{r}_{level}"
            out += f"""
, boost_sums{s} AS (SELECT node, feature, bin, CAST(sum(g) AS BIGINT) AS g, CAST(sum(h) AS BIGINT) AS h, count(*) AS n
  FROM boost_at{s} JOIN boost_g{r} USING (rid) JOIN boost_bins USING (rid) WHERE node >= {1 << level} GROUP BY ALL)
, boost_side{s} AS (SELECT *, CASE WHEN feature IN ({known}) THEN (CAST(g AS DOUBLE) / {unit}) / (CAST(h AS DOUBLE) / {unit} + {l2}) ELSE bin END AS place,
  sum(g) OVER f AS ag, sum(h) OVER f AS ah, sum(n) OVER f AS an, coalesce(sum(CASE WHEN bin < 0 THEN g END) OVER f, 0) AS mg,
  coalesce(sum(CASE WHEN bin < 0 THEN h END) OVER f, 0) AS mh, coalesce(sum(CASE WHEN bin < 0 THEN n END) OVER f, 0) AS mn
  FROM boost_sums{s} WINDOW f AS (PARTITION BY node, feature))
, boost_cut{s} AS (SELECT node, feature, bin, place, missing_left, CAST(sg + m * mg AS DOUBLE) / {unit} AS lg, CAST(sh + m * mh AS DOUBLE) / {unit} AS lh,
  sn + m * mn AS n_left, an - sn - m * mn AS n_right, CAST(ag - sg - m * mg AS DOUBLE) / {unit} AS rg, CAST(ah - sh - m * mh AS DOUBLE) / {unit} AS rh,
  CAST(ag AS DOUBLE) / {unit} AS g, CAST(ah AS DOUBLE) / {unit} AS h, bins
  FROM (SELECT *, sum(g) OVER c AS sg, sum(h) OVER c AS sh, sum(n) OVER c AS sn, list(bin) OVER c AS bins FROM boost_side{s} WHERE bin >= 0
    WINDOW c AS (PARTITION BY node, feature ORDER BY place, bin ROWS UNBOUNDED PRECEDING)) q, (VALUES (FALSE, 0), (TRUE, 1)) AS d(missing_left, m))
, boost_best{s} AS MATERIALIZED (SELECT {r + 1} AS tree, node, feature, bin, bins, missing_left, gain, n_left, n_right,
  -{step} * lg / (lh + {l2}) AS left_value, -{step} * rg / (rh + {l2}) AS right_value
  FROM (SELECT *, lg * lg / (lh + {l2}) + rg * rg / (rh + {l2}) - g * g / (h + {l2}) AS gain FROM boost_cut{s} WHERE n_left >= {least} AND n_right >= {least}) q
  WHERE gain > 1e-6 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, place, bin, missing_left) = 1)
, boost_at{r}_{level + 1} AS MATERIALIZED (SELECT a.rid, CASE WHEN s.node IS NULL THEN a.node
    WHEN CASE WHEN b.bin = -1 THEN s.missing_left WHEN s.feature IN ({known}) THEN list_contains(s.bins, b.bin) ELSE b.bin <= list_max(s.bins) END
    THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
  FROM boost_at{s} a LEFT JOIN boost_best{s} s USING (node) LEFT JOIN boost_bins b ON b.rid = a.rid AND b.feature = s.feature)"""
            splits.append(f"SELECT * FROM boost_best{s}")
        own = " UNION ALL ".join(splits[-depth:])
        out += f"""
, boost_margins{r + 1} AS MATERIALIZED (SELECT m.rid, m.split, m.y, m.margin + coalesce(v.value, 0) AS margin
  FROM boost_margins{r} m JOIN boost_at{r}_{depth} a USING (rid) LEFT JOIN (
    SELECT 2 * node AS node, left_value AS value FROM ({own}) l UNION ALL SELECT 2 * node + 1, right_value FROM ({own}) l) v ON v.node = a.node)"""
    return out + f"""
, boost_splits AS (SELECT *, {names} AS name FROM ({' UNION ALL '.join(splits)}) q)
, boost_margins AS (SELECT r.msno, r.feature_cutoff_date, r.is_churn, r.split, m.margin FROM boost_margins{rounds} m JOIN boost_rows r USING (rid))"""
