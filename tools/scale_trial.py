"""Time the main jobs on generated sources of a chosen size, with one user owning a third of the rows.

usage: python tools/scale_trial.py OUTPUT_FOLDER [million_log_rows] [hot]
Not part of the registered queries: it shows how plans behave beyond the given tables.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stayline.operators import cohort, drift, features, labels, pit, ranking  # noqa: E402
from stayline.schemas import FEATURES  # noqa: E402
from stayline.session import local_session, stage  # noqa: E402


def generate(spark, root: str, log_rows: int, hot: bool) -> None:
    users = max(log_rows // 16, 1000)
    start = F.lit("2016-09-01").cast("date")
    ymd = lambda d: (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
    pick = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    third = F.lit(hot) & (F.col("id") % 3 == 0)
    user = F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("user-000000000000-"), pick(1, users).cast("string")))

    day = F.date_add(start, pick(2, 210))
    spark.range(log_rows).select(
        user.alias("msno"), ymd(day).alias("date"),
        *[pick(10 + i, 40).alias(c) for i, c in enumerate(["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"])],
        (pick(20, 9000000) / 100).cast("float").alias("total_secs"),
    ).write.parquet(f"{root}/user_logs")

    paid = F.date_add(start, pick(3, 210))
    spark.range(log_rows // 12).select(
        user.alias("msno"), F.lit(41).cast("short").alias("payment_method_id"), F.lit(30).cast("short").alias("payment_plan_days"),
        F.lit(149).alias("plan_list_price"), F.when(pick(4, 9) == 0, 0).otherwise(149).alias("actual_amount_paid"),
        F.lit(1).cast("short").alias("is_auto_renew"), ymd(paid).alias("transaction_date"),
        ymd(F.date_add(paid, F.lit(30))).alias("membership_expire_date"), (pick(5, 10) == 0).cast("short").alias("is_cancel"),
    ).write.parquet(f"{root}/transactions")

    spark.range(users).select(
        F.concat(F.lit("user-000000000000-"), F.col("id").cast("string")).alias("msno"), F.lit(1).cast("short").alias("city"),
        F.lit(30).cast("short").alias("bd"), F.lit(None).cast("string").alias("gender"), F.lit(7).cast("short").alias("registered_via"),
        ymd(F.date_add(F.lit("2010-01-01").cast("date"), pick(6, 2500))).alias("registration_init_time"),
    ).write.parquet(f"{root}/members")


def main() -> None:
    root = sys.argv[1]
    rows = int(float(sys.argv[2]) * 1_000_000) if len(sys.argv) > 2 else 18_400_000
    hot = "hot" in sys.argv[3:]
    spark = local_session("8", "16", "20g")

    def timed(name, action):
        start = time.perf_counter()
        out = action()
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
        return out

    if not Path(f"{root}/members").exists():
        timed("generate", lambda: generate(spark, root, rows, hot))
    txn, logs, members = (spark.read.parquet(f"{root}/{n}") for n in ("transactions", "user_logs", "members"))
    print({"transactions": txn.count(), "user_logs": logs.count(), "members": members.count(), "hot": hot})
    noop = lambda df: df.write.format("noop").mode("overwrite").save()

    found = timed("labels of a month", lambda: stage(labels.month_labels(txn, "2017-03", "2017-05-01"), "l"))
    users = timed("cohort", lambda: pit.staged_cohort(found.select("msno", "feature_cutoff_date")))
    print({"cohort": users.count()})
    p99 = timed("winsor threshold", lambda: features.p99_secs(logs, users, 20170317).first()[0])
    matrix = timed("feature matrix", lambda: stage(
        features.feature_matrix(users, txn, logs, members, p99, 20170317), "m"))
    timed("log features, shuffled", lambda: noop(features.log_features(logs, users, p99, last_cutoff=20170317, hint="merge")))
    timed("drift of all features", lambda: noop(drift.feature_drift(matrix, matrix, FEATURES)))
    scored = found.join(matrix.select("msno", "tenure_days"), "msno").select(
        "msno", (F.pmod(F.xxhash64("msno"), F.lit(10**9)) / 1e9).alias("score"), "is_churn")
    timed("ranking metrics", lambda: noop(ranking.ranking_metrics(scored)))
    timed("global quantiles of seconds", lambda: noop(features.p99_secs(logs)))


if __name__ == "__main__":
    main()
