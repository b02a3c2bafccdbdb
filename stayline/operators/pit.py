"""Point-in-time aggregates: what is known of a user up to each cohort row's own cutoff day.

A fact is never copied for the cutoffs after it. It goes to its interval, the first cutoff of
its user on or after its day, where it is aggregated; a user's intervals are then merged one
after another, so each cutoff has everything up to it. Rows after the join are at most the
facts and the cohort, rows after the merge the cohort's, however many cutoffs a user has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.session import stage

CUTOFF = "feature_cutoff_date"


def staged_cohort(cohort: DataFrame) -> DataFrame:
    """The cohort as a stored table.

    Features read a cohort several times, and a stored table has a size that Spark knows:
    its own byte threshold then decides whether the cohort is broadcast.
    """
    return stage(cohort, "cohort")


def user_cutoffs(cohort: DataFrame) -> DataFrame:
    """(msno, cutoffs): each user's cutoff days in order; no more than the calendar has."""
    return cohort.groupBy("msno").agg(F.sort_array(F.collect_set(CUTOFF)).alias("cutoffs"))


def _from(day: str) -> Column:
    return F.filter("cutoffs", lambda c: c >= F.col(day))


def _joined(facts: DataFrame, cohort: DataFrame, hint: str | None) -> DataFrame:
    users = user_cutoffs(cohort)
    return facts.join(users.hint(hint) if hint else users, "msno")


def in_intervals(facts: DataFrame, cohort: DataFrame, day: str, hint: str | None = None) -> DataFrame:
    """The facts of cohort users with the first cutoff on or after ``day``, and a row of NULLs for each cohort row.

    Facts after all cutoffs go. ``hint`` forces a join strategy. Facts should be a row per
    user and day, which bounds the rows of any user by the calendar. The caller aggregates
    by (msno, cutoff).
    """
    found = _joined(facts, cohort, hint).withColumn(CUTOFF, F.array_min(_from(day)))
    found = found.where(F.col(CUTOFF).isNotNull()).drop("cutoffs")
    return found.unionByName(cohort.select("msno", CUTOFF), allowMissingColumns=True)


def times_counted(facts: DataFrame, cohort: DataFrame, day: str, name: str, hint: str | None = None) -> DataFrame:
    """The facts of cohort users with the number of their user's cutoffs on or after ``day``, one at least."""
    found = _joined(facts, cohort, hint).withColumn(name, F.size(_from(day)).cast("bigint"))
    return found.where(F.col(name) > 0).drop("cutoffs")


def running_totals(intervals: DataFrame, sums: list[str], largest: list[str]) -> DataFrame:
    """Per (msno, cutoff) the sums, and the largest values, over its own and all earlier intervals.

    ``intervals`` is unique by that key. Rows that no fact precedes, whose first sum is
    still NULL, go. A user's rows in the window are its cutoffs.
    """
    so_far = Window.partitionBy("msno").orderBy(CUTOFF).rowsBetween(Window.unboundedPreceding, 0)
    totals = intervals.select("msno", CUTOFF, *[F.sum(c).over(so_far).alias(c) for c in sums], *[F.max(c).over(so_far).alias(c) for c in largest])
    return totals.where(F.col(sums[0]).isNotNull())


def known_at_cutoffs(cohort: DataFrame, facts: dict[str, tuple[DataFrame, str, list[str], list[str]]]) -> DataFrame:
    """The cohort's rows, packed as ``_row``, with what their user's facts on or before their cutoff add up to.

    ``facts`` names frames, each with its day column, the columns to sum and those to take the
    largest of; what is known comes as a struct of that name, with NULLs if no fact precedes.
    Rows and facts of all frames meet in one shuffle and one sort by user, without a join or a
    copy; a user's rows in the window are its cohort rows and its facts, which should be a row
    per day. Made for cohorts that hold most users: facts of others are shuffled, too.
    """
    others = [c for c in cohort.columns if c != "msno"]
    both = cohort.select("msno", F.col(CUTOFF).alias("_day"), F.lit(True).alias("_asks"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"))
    for name, (frame, day, sums, largest) in facts.items():
        known = frame.where(F.col("msno").isNotNull() & F.col(day).isNotNull())
        packed = known.select("msno", F.col(day).alias("_day"), F.lit(False).alias("_asks"), F.struct(*sums, *largest).alias(name))
        both = both.unionByName(packed, allowMissingColumns=True)
    # Facts of a day come before the cutoff of that day, which they count for.
    so_far = Window.partitionBy("msno").orderBy("_day", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    found = [
        F.struct(
            *[F.sum(f"{name}.{c}").over(so_far).alias(c) for c in sums], *[F.max(f"{name}.{c}").over(so_far).alias(c) for c in largest]
        ).alias(f"{name}")
        for name, (_, _, sums, largest) in facts.items()
    ]
    read = both.select("msno", "_asks", "_row", *found).where("_asks")
    return read.select(F.struct(*["msno" if c == "msno" else F.col(f"_row.`{c}`") for c in cohort.columns]).alias("_row"), *facts)
