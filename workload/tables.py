"""Shape the given order, event and customer tables into subscription sources.

Orders become payments, events become daily usage, customers become members. ``Tables``
builds them with the DataFrame API; ``SQL`` says the same for the oracle engine. The views
read their base tables whole: every customer is a member (without a registration day where
the balance is negative) and has an official label.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EVENT_SHIFT_DAYS = 8341

# The base columns in use. A declared schema saves a job that would only read file footers.
BASE = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
}


def _ymd(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


class Tables:
    """Lazy subscription views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _payments(self) -> DataFrame:
        key, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
        expiry = (
            F.when(key % 97 == 0, F.date_sub(d, 2))
            .when(key % 10 == 3, F.date_add(d, 90))
            .otherwise(F.date_add(d, 30))
        )
        return self.raw("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", d.alias("d"), expiry.alias("e")
        )

    @cached_property
    def transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        legacy, long_plan = key % 50 == 0, key % 10 == 3
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
        cancelled = (F.col("o_orderstatus") == "F") & (key % 3 == 0)
        return self._payments.select(
            F.col("o_custkey").cast("string").alias("msno"),
            (key % 40).cast("short").alias("payment_method_id"),
            F.when(legacy, 0).when(long_plan, 90).otherwise(30).cast("short").alias("payment_plan_days"),
            F.when(legacy, 0).when(long_plan, 447).otherwise(149).alias("plan_list_price"),
            F.when(legacy, 149).when(key % 7 == 0, 0).when(long_plan, 400).otherwise(149).alias("actual_amount_paid"),
            F.when(urgent, 1).otherwise(0).cast("short").alias("is_auto_renew"),
            _ymd(F.col("d")).alias("transaction_date"),
            _ymd(F.col("e")).alias("membership_expire_date"),
            F.when(cancelled, 1).otherwise(0).cast("short").alias("is_cancel"),
        )

    @cached_property
    def user_logs(self) -> DataFrame:
        def plays(kind: str, name: str) -> Column:
            return F.count_if(F.col("event_type") == kind).cast("int").alias(name)

        days = self.raw("events").withColumn("d", F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT_DAYS))
        return (
            days.groupBy("user_id", "d")
            .agg(
                plays("error", "num_25"),
                plays("view", "num_50"),
                plays("click", "num_75"),
                plays("signup", "num_985"),
                plays("purchase", "num_100"),
                F.countDistinct("props").cast("int").alias("num_unq"),
                (F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double") * 1.5).alias("total_secs"),
            )
            .select(
                F.col("user_id").cast("string").alias("msno"),
                _ymd(F.col("d")).alias("date"),
                "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs",
            )
        )

    @cached_property
    def members(self) -> DataFrame:
        key = F.col("c_custkey")
        registered = F.date_add(F.lit("1999-01-01").cast("date"), ((key * 13) % 1200).cast("int"))
        return self.raw("customer").select(
            key.cast("string").alias("msno"),
            F.col("c_nationkey").cast("short").alias("city"),
            ((key * 7) % 130 - 5).cast("short").alias("bd"),
            F.when(key % 3 == 0, "male").when(key % 3 == 1, "female").alias("gender"),
            (key % 5 + 3).cast("short").alias("registered_via"),
            F.when(F.col("c_acctbal") >= 0, _ymd(registered)).alias("registration_init_time"),
        )

    @cached_property
    def train(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.cast("string").alias("msno"),
            F.when((key * 31) % 100 < 50, 1).otherwise(0).cast("short").alias("is_churn"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        key, e = F.max("o_orderkey"), F.col("e")
        return (
            self._payments.where("e >= d")
            .groupBy("o_custkey", "e")
            .agg(
                (((key * 7919 + 104729) % 1009).cast("double") / 1008.0).alias("score"),
                (((key * 104729 + 7919) % 1013).cast("double") / 1012.0).alias("rival_score"),
            )
            .select(
                F.col("o_custkey").cast("string").alias("msno"),
                "score",
                "rival_score",
                F.date_sub(e, 14).alias("scoring_date"),
                e.alias("expiry_date"),
                F.when(e < F.lit("2001-03-01").cast("date"), "m1").otherwise("m2").alias("model_version"),
            )
        )

    @property
    def sources(self) -> dict[str, DataFrame]:
        return {
            "transactions": self.transactions,
            "user_logs": self.user_logs,
            "members": self.members,
            "train_labels": self.train,
        }


SQL = """
WITH sub_base AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS d,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_orderdate AS DATE) - 2
              WHEN o_orderkey % 10 = 3 THEN CAST(o_orderdate AS DATE) + 90
              ELSE CAST(o_orderdate AS DATE) + 30 END AS DATE) AS e
  FROM orders
), sub_transactions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS msno,
    CAST(o_orderkey % 40 AS SMALLINT) AS payment_method_id,
    CAST(CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 10 = 3 THEN 90 ELSE 30 END AS SMALLINT) AS payment_plan_days,
    CAST(CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 10 = 3 THEN 447 ELSE 149 END AS INT) AS plan_list_price,
    CAST(CASE WHEN o_orderkey % 50 = 0 THEN 149 WHEN o_orderkey % 7 = 0 THEN 0
              WHEN o_orderkey % 10 = 3 THEN 400 ELSE 149 END AS INT) AS actual_amount_paid,
    CAST(CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') THEN 1 ELSE 0 END AS SMALLINT) AS is_auto_renew,
    CAST(year(d)*10000 + month(d)*100 + day(d) AS INT) AS transaction_date,
    CAST(year(e)*10000 + month(e)*100 + day(e) AS INT) AS membership_expire_date,
    CAST(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS is_cancel
  FROM sub_base
), sub_logbase AS (
  SELECT user_id, CAST(CAST(ts AS DATE) - 8341 AS DATE) AS d, event_type, value, props FROM events
), sub_user_logs AS (
  SELECT CAST(user_id AS VARCHAR) AS msno, CAST(year(d)*10000 + month(d)*100 + day(d) AS INT) AS date,
    CAST(SUM(CASE WHEN event_type = 'error'    THEN 1 ELSE 0 END) AS INT) AS num_25,
    CAST(SUM(CASE WHEN event_type = 'view'     THEN 1 ELSE 0 END) AS INT) AS num_50,
    CAST(SUM(CASE WHEN event_type = 'click'    THEN 1 ELSE 0 END) AS INT) AS num_75,
    CAST(SUM(CASE WHEN event_type = 'signup'   THEN 1 ELSE 0 END) AS INT) AS num_985,
    CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS num_100,
    CAST(COUNT(DISTINCT props) AS INT) AS num_unq,
    CAST(SUM(CAST(round(value*100) AS BIGINT)) AS DOUBLE) * CAST(1.5 AS DOUBLE) AS total_secs
  FROM sub_logbase GROUP BY user_id, d
), sub_members AS (
  SELECT CAST(c_custkey AS VARCHAR) AS msno, CAST(c_nationkey AS SMALLINT) AS city,
    CAST((c_custkey * 7) % 130 - 5 AS SMALLINT) AS bd,
    CASE WHEN c_custkey % 3 = 0 THEN 'male' WHEN c_custkey % 3 = 1 THEN 'female' END AS gender,
    CAST(c_custkey % 5 + 3 AS SMALLINT) AS registered_via,
    CAST(CASE WHEN c_acctbal >= 0 THEN year(r)*10000 + month(r)*100 + day(r) END AS INT) AS registration_init_time
  FROM (SELECT c_custkey, c_nationkey, c_acctbal,
          CAST(DATE '1999-01-01' + CAST((c_custkey * 13) % 1200 AS INT) AS DATE) AS r
        FROM customer) q
), sub_train AS (
  SELECT CAST(c_custkey AS VARCHAR) AS msno,
    CAST(CASE WHEN (c_custkey * 31) % 100 < 50 THEN 1 ELSE 0 END AS SMALLINT) AS is_churn
  FROM customer
), sub_predictions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS msno,
    CAST((MAX(o_orderkey) * 7919 + 104729) % 1009 AS DOUBLE) / CAST(1008 AS DOUBLE) AS score,
    CAST((MAX(o_orderkey) * 104729 + 7919) % 1013 AS DOUBLE) / CAST(1012 AS DOUBLE) AS rival_score,
    CAST(e - 14 AS DATE) AS scoring_date, e AS expiry_date,
    CASE WHEN e < DATE '2001-03-01' THEN 'm1' ELSE 'm2' END AS model_version
  FROM sub_base WHERE e >= d
  GROUP BY o_custkey, e
)
"""
