"""Store constraints as queries over the rows that break them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

# Fixed value: the format of user ids accepted by readers of the prediction store.
USER_ID_PATTERN = r"^[a-zA-Z0-9_\-+/=]{1,64}$"

# What the stores' value columns may hold.
TIERS = ["HIGH", "MED", "LOW"]
LABEL_VALUES = [0, 1]
MOST_ID_LETTERS = 64


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate {keys}")
    return df


def domain_violations(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is NULL or outside the allowed set."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(values))


def in_unit_interval(score: Column) -> Column:
    """The score itself, or a runtime error when it is outside [0, 1] or not a number."""
    bad = F.isnan(score) | (score < 0.0) | (score > 1.0)
    message = F.concat(F.lit("score outside [0, 1]: "), score.cast("string"))
    return F.when(bad, F.raise_error(message).cast("double")).otherwise(score)


def count_violations(df: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """(check_name, n_violations) for row rules, plus surplus rows of duplicated keys.

    All row rules are counted in one pass over the table.
    """
    counted = df.agg(*[F.count_if(F.coalesce(cond, F.lit(True))).alias(name) for name, cond in rules.items()])
    rows = counted.unpivot([], list(rules), "check_name", "n_violations")
    surplus = duplicate_keys(df, keys).agg(
        F.lit("duplicate_key").alias("check_name"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint").alias("n_violations"),
    )
    return rows.unionByName(surplus)


def store_rules(df: DataFrame, store: StructType) -> dict[str, Column]:
    """What a row of ``df`` must not be, by rule name, to enter a store of this schema.

    The rules are about the store's columns that ``df`` has; a NULL breaks its column's
    ``_null`` rule and no other.
    """
    has = [f for f in store.fields if f.name in df.columns]
    rules = {f"{f.name}_null": F.col(f.name).isNull() for f in has if not f.nullable}
    domains = {
        "score": ~F.col("score").between(0.0, 1.0),
        "risk_tier": ~F.col("risk_tier").isin(TIERS),
        "is_churn": ~F.col("is_churn").isin(LABEL_VALUES),
        "msno": F.length("msno") > MOST_ID_LETTERS,
        "model_version": F.length("model_version") > MOST_ID_LETTERS,
    }
    return rules | {f"{f.name}_domain": F.coalesce(domains[f.name], F.lit(False)) for f in has if f.name in domains}
