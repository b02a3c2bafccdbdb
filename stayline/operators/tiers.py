"""Risk tiers from score intervals."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stayline.operators.checks import in_unit_interval

TIER_NAMES = ("HIGH", "MED", "LOW")


@dataclass(frozen=True)
class Tier:
    name: str
    score_min: float
    score_max: float
    inclusive_min: bool = True
    inclusive_max: bool = False

    def holds(self, score: Column) -> Column:
        low = score >= self.score_min if self.inclusive_min else score > self.score_min
        high = score <= self.score_max if self.inclusive_max else score < self.score_max
        return low & high


# The default score intervals.
DEFAULT_TIERS = (
    Tier("HIGH", 0.5, 1.0, True, True),
    Tier("MED", 0.2, 0.5, True, False),
    Tier("LOW", 0.0, 0.2, True, False),
)


def check_tiers(tiers: tuple[Tier, ...]) -> tuple[Tier, ...]:
    """Three differently named tiers that tile [0, 1]; anything else is an error."""
    if sorted(str(t.name) for t in tiers) != sorted(TIER_NAMES):
        raise ValueError(f"tiers must be exactly {TIER_NAMES}, got {[t.name for t in tiers]}")
    for t in tiers:
        if not all(isinstance(x, (int, float)) for x in (t.score_min, t.score_max)):
            raise ValueError(f"tier {t.name}: score_min and score_max must be numbers")
        if not 0.0 <= t.score_min < t.score_max <= 1.0:
            raise ValueError(f"tier {t.name}: need 0 <= score_min < score_max <= 1")
    ordered = sorted(tiers, key=lambda t: t.score_min)
    if ordered[0].score_min != 0.0 or ordered[-1].score_max != 1.0:
        raise ValueError("tiers must start at 0.0 and end at 1.0")
    for left, right in zip(ordered, ordered[1:]):
        if left.score_max != right.score_min:
            raise ValueError(f"gap or overlap between {left.score_max} and {right.score_min}")
    return tiers


def load_tiers(path: str) -> tuple[Tier, ...]:
    """Tiers from a JSON file with a ``tiers`` list (and strategy ``fixed_threshold``)."""
    with open(path) as f:
        config = json.load(f)
    strategy = config.get("strategy", "fixed_threshold")
    if strategy != "fixed_threshold":
        raise ValueError(f"unknown tier strategy {strategy!r}")
    names = ("name", "score_min", "score_max", "inclusive_min", "inclusive_max")
    return check_tiers(tuple(Tier(**{n: t.get(n) for n in names}) for t in config.get("tiers", [])))


def risk_tier(score: Column, tiers: tuple[Tier, ...] = DEFAULT_TIERS) -> Column:
    """The first tier that holds the score; a score outside [0, 1] fails the job."""
    checked = in_unit_interval(score.cast("double"))
    out = None
    for t in check_tiers(tiers):
        out = F.when(t.holds(checked), t.name) if out is None else out.when(t.holds(checked), t.name)
    unmatched = F.raise_error(F.concat(F.lit("no tier for score "), score.cast("string")))
    return out.otherwise(F.when(score.isNotNull(), unmatched.cast("string")))


def with_risk_tier(scored: DataFrame, tiers: tuple[Tier, ...] = DEFAULT_TIERS) -> DataFrame:
    """Add ``risk_tier``. Assigned on the double score, before any float32 cast."""
    return scored.withColumn("risk_tier", risk_tier(F.col("score"), tiers))


def tier_distribution(tiered: DataFrame) -> DataFrame:
    """Count and share of each tier."""
    counts = tiered.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.select("risk_tier", "cnt", (F.col("cnt") / total).alias("share"))
