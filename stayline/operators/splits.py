"""Disjoint train / val / test assignment as one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _hex_bound(fraction: float) -> str:
    """First 8 hex digits of an MD5 lie below this with the given probability."""
    if not 0.0 < fraction < 1.0:
        raise ValueError(f"fraction must be in (0, 1), got {fraction}")
    return f"{int(fraction * 2**32):08x}"


def hash_draw(seed: int, key: str = "msno") -> Column:
    """A reproducible draw per user that does not depend on row order or partitioning.

    A draw per key keeps every class at the same share in expectation, and all rows of a
    user on the same side of the split.
    """
    return F.substring(F.md5(F.concat(F.col(key), F.lit(f"|{seed}"))), 1, 8)


def _recent_months(df: DataFrame, known: list[str] | None) -> Column:
    """Cohort months, latest first.

    When the caller knows them, as from the label table, they are literals; else a scalar
    subquery, which computes ``df`` once more unless it is a stored table.
    """
    if known is not None:
        return F.array(*[F.lit(m) for m in sorted(set(known), reverse=True)])
    months = df.select("cohort_month").distinct()
    return months.agg(F.sort_array(F.collect_set("cohort_month"), asc=False)).scalar()


def split_3way(
    df: DataFrame,
    val_fraction: float = 0.15,
    test_fraction: float = 0.15,
    seed: int = 42,
    months: list[str] | None = None,
) -> DataFrame:
    """Add ``split``: latest month = test, the one before = val, the rest = train.

    With fewer than three months (or no month column) the split is random by user.
    """
    if not (0.0 < val_fraction < 1.0 and 0.0 < test_fraction < 1.0 and val_fraction + test_fraction < 1.0):
        raise ValueError("val_fraction and test_fraction must be in (0, 1) and sum to less than 1")
    draw = hash_draw(seed)
    random = (
        F.when(draw < _hex_bound(test_fraction), "test")
        .when(draw < _hex_bound(test_fraction + val_fraction), "val")
        .otherwise("train")
    )
    if "cohort_month" not in df.columns:
        return df.withColumn("split", random)
    recent = _recent_months(df, months)
    by_time = (
        F.when(F.col("cohort_month") == F.get(recent, F.lit(0)), "test")
        .when(F.col("cohort_month") == F.get(recent, F.lit(1)), "val")
        .otherwise("train")
    )
    return df.withColumn("split", F.when(F.size(recent) >= 3, by_time).otherwise(random))


def split_2way(
    df: DataFrame, val_fraction: float = 0.2, seed: int = 42, months: list[str] | None = None
) -> DataFrame:
    """Add ``split``: latest month = val when there are two or more, else random by user."""
    random = F.when(hash_draw(seed) < _hex_bound(val_fraction), "val").otherwise("train")
    if "cohort_month" not in df.columns:
        return df.withColumn("split", random)
    recent = _recent_months(df, months)
    latest = F.col("cohort_month") == F.get(recent, F.lit(0))
    by_time = F.when(latest, "val").otherwise("train")
    return df.withColumn("split", F.when(F.size(recent) >= 2, by_time).otherwise(random))
