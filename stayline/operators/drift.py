"""Population stability between a baseline and a current feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayline.schemas import require_columns

# Fixed value: stands in for an empty bin, so that the logarithm is defined.
EMPTY_BIN_SHARE = 1e-4


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "feature", "x")
        .where(F.col("x").isNotNull() & ~F.isnan("x"))
    )


def _counted(side: DataFrame, ranges: DataFrame, bins: int) -> DataFrame:
    """(feature, n, counts) of a long table: all values, and those of each bin.

    ``ranges`` has one row (_feature, lo, hi) per feature, so it is broadcast. The last bin is
    open to the right; a value below the range counts in ``n`` only. Before the last step at
    most bins + 1 rows per feature are left.
    """
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    bin_no = F.lit(-1)
    for i in range(bins):
        bin_no = bin_no + (F.col("x") >= F.col("lo") + F.lit(float(i)) * step).cast("int")
    tallies = (
        side.join(F.broadcast(ranges), F.col("feature") == F.col("_feature"))
        .groupBy("feature", bin_no.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_bin = [F.coalesce(F.sum(F.when(F.col("_bin") == i, F.col("_n"))), F.lit(0)) for i in range(bins)]
    return tallies.groupBy("feature").agg(F.sum("_n").alias("n"), F.array(*per_bin).alias("counts"))


def histograms(baseline: DataFrame, columns: list[str], bins: int = 10, ranges: DataFrame | None = None) -> DataFrame:
    """(feature, lo, hi, n, counts): all that a drift check needs of a baseline.

    Bins divide a feature's range evenly; a constant feature gets a range of width 1 around its
    value, one without values has no row. With ``ranges``, an earlier result of this function,
    the bins are taken from there, so that both can be added by :func:`add_histograms`.
    """
    require_columns(baseline, columns, "baseline")
    base = _long(baseline, columns)
    if ranges is None:
        lo, hi = F.min("x"), F.max("x")
        found = base.groupBy("feature").agg(
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        )
    else:
        found = ranges.select("feature", "lo", "hi")
    found = found.withColumnRenamed("feature", "_feature")
    counted = _counted(base, found, bins)
    return counted.join(F.broadcast(found), F.col("feature") == F.col("_feature")).select("feature", "lo", "hi", "n", "counts")


def add_histograms(parts: DataFrame) -> DataFrame:
    """The sum of histograms over equal ranges, for a baseline that was counted in parts."""
    bins = F.posexplode("counts").alias("_bin", "_n")
    summed = (
        parts.select("feature", "lo", "hi", bins).groupBy("feature", "lo", "hi", "_bin").agg(F.sum("_n").alias("_n"))
        .groupBy("feature", "lo", "hi").agg(F.transform(F.sort_array(F.collect_list(F.struct("_bin", "_n"))), lambda b: b["_n"]).alias("counts"))
    )
    totals = parts.groupBy("feature").agg(F.sum("n").alias("n"), F.count_distinct("lo", "hi").alias("_ranges"))
    n = F.when(F.col("_ranges") > 1, F.raise_error(F.concat(F.lit("different ranges of "), "feature")).cast("bigint")).otherwise(F.col("n"))
    return summed.join(totals, "feature").select("feature", "lo", "hi", n.alias("n"), "counts")


def drift_from(stored: DataFrame, current: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """(feature, psi) of a table against stored :func:`histograms`; of the two, only it is scanned.

    A feature without values on either side has psi 0.
    """
    require_columns(current, columns, "current")
    ranges = stored.select(F.col("feature").alias("_feature"), "lo", "hi")
    now = _counted(_long(current, columns), ranges, bins)
    odd = F.raise_error(F.concat(F.lit("other number of bins stored for "), "_feature")).cast("array<bigint>")
    base = stored.select(F.col("feature").alias("_feature"), F.col("n").alias("nb"), F.col("counts").alias("_b"))
    base = base.withColumn("_b", F.when(F.size("_b") == bins, F.col("_b")).otherwise(odd))

    def share(count: Column, total: Column) -> Column:
        s = F.try_divide(count.cast("double"), total.cast("double"))
        return F.when(s == 0.0, F.lit(EMPTY_BIN_SHARE)).otherwise(s)

    psi = F.lit(0.0)
    for i in range(bins):
        b = share(F.get("_b", F.lit(i)), F.col("nb"))
        c = share(F.get("counts", F.lit(i)), F.col("n"))
        psi = psi + (c - b) * F.ln(c / b)
    # A row per feature on both sides.
    scored = now.join(F.broadcast(base), F.col("feature") == F.col("_feature")).select(
        "_feature", F.when((F.col("nb") > 0) & (F.col("n") > 0), psi).alias("_psi")
    )
    # Features without values have no row; the full name list brings them back as 0.
    names = current.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature")
    )
    return names.join(F.broadcast(scored), F.col("feature") == F.col("_feature"), "left").select(
        "feature", F.coalesce("_psi", F.lit(0.0)).alias("psi")
    )


def feature_drift(
    baseline: DataFrame, current: DataFrame, columns: list[str], bins: int = 10
) -> DataFrame:
    """(feature, psi) for each column, both tables given.

    The baseline is read twice, for ranges and for counts: a baseline that is compared more
    than once is better kept as :func:`histograms`.
    """
    return drift_from(histograms(baseline, columns, bins), current, columns, bins)


def psi_single(baseline: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """PSI of one column, as one row."""
    return feature_drift(baseline, current, [column], bins)


def drift_alerts(drift: DataFrame, threshold: float = 0.2) -> DataFrame:
    """One row: how many features drifted, and which (at most one entry per feature)."""
    if threshold <= 0:
        raise ValueError(f"threshold must be positive, got {threshold}")
    hit = F.col("psi") > threshold
    return drift.agg(
        F.count_if(hit).alias("n_drifted_features"),
        F.array_join(F.sort_array(F.collect_list(F.when(hit, F.col("feature")))), ",").alias(
            "drifted_features"
        ),
    )
