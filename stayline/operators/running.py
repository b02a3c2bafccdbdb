"""Cumulative sums and exact quantiles over a global order, without a one-task sort.

Rows are range-partitioned along the order into as many buckets as the session has shuffle
partitions, and stored; bucket totals, one row each, get a running sum, and each bucket adds
its own. Where a bucket ends comes from Spark's sample of the order; it only balances the
work and never changes a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.functions.numbers import exact_mean, exact_parts
from stayline.session import stage


def bucketed(df: DataFrame, order: list[str], parts: int | None = None, name: str = "buckets") -> DataFrame:
    """The rows, stored with ``_bucket``: the number of their range along ``order``.

    Stored, because a sample drawn again could cut elsewhere: totals and rows must agree.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(n, *order).withColumn("_bucket", F.spark_partition_id()), name)


def running_sums(df: DataFrame, order: str, sums: list[str], parts: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Add ``cum_<name>`` for each name: the sum over rows with order >= this row's.

    ``order`` must be unique in ``df`` (group by it first), or, given the columns ``by``, in
    each of their groups; sums then run within a group. A group may be longer than a task
    should hold, or there may be very many short ones: buckets are ranges of (by, order).
    """
    by = by or []
    rows = bucketed(df, [*by, order], parts, "running")
    inside = Window.partitionBy(*by, "_bucket").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    above = (Window.partitionBy(*by) if by else Window).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket, so no more than there are shuffle partitions: a single task is fine.
    # With groups, one more for each that begins inside a bucket: these are joined, not broadcast.
    bases = rows.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(s) for s in sums]).select(
        F.col("_bucket").alias("_b"), *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.coalesce(F.sum(s).over(above), F.lit(0)).alias(f"_base_{s}") for s in sums],
    )
    same = F.col("_bucket") == F.col("_b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return rows.join(bases if by else F.broadcast(bases), same).select(
        *df.columns, *[(F.col(f"_base_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums]
    )


Brackets = list[tuple[float, float]]


def rank_brackets(df: DataFrame, columns: list[str], quantiles: list[float]) -> dict[str, Brackets]:
    """Per column, value ranges that are sure to hold the wanted quantiles.

    The rows are taken in up to 512 groups of tasks. The quantile of a union lies between the
    smallest and the largest quantile of its parts, and each part's quantile lies between its
    approximate ones one error bound below and above. So this needs one scan, no shuffle of
    values, and merges sketches in parallel; only two numbers per quantile reach the driver.
    """
    accuracy = 2_000
    # A margin must cover the sketch's error and the one or two ranks by which definitions of
    # a quantile differ, which is much of a small group: each group takes the first that does.
    margins = [2.0 / accuracy, 0.02, 0.2, 1.0]
    enough = [2.0 / (m - 1.0 / accuracy) for m in margins[:-1]]
    low = [max(q - m, 0.0) for q in quantiles for m in margins]
    high = [min(q + m, 1.0) for q in quantiles for m in margins]
    group = F.spark_partition_id() % 512
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.percentile_approx(v, low, accuracy).alias(f"{c}_low"),
            F.percentile_approx(v, high, accuracy).alias(f"{c}_high"),
            F.count(v).alias(f"{c}_n"),
        ]
    parts = df.select(*columns, group.alias("_group")).groupBy("_group").agg(*aggs)
    ends = []
    for c in columns:
        n = F.col(f"{c}_n")
        margin = F.when(n >= enough[0], 0).when(n >= enough[1], 1).when(n >= enough[2], 2).otherwise(3)
        for i in range(len(quantiles)):
            at = F.lit(i * len(margins)) + margin
            ends.append(F.min(F.get(f"{c}_low", at)).alias(f"{c}_low{i}"))
            ends.append(F.max(F.get(f"{c}_high", at)).alias(f"{c}_high{i}"))
    row = parts.agg(*ends).first()

    return {
        c: _merged([(row[f"{c}_low{i}"], row[f"{c}_high{i}"]) for i in range(len(quantiles)) if row[f"{c}_low{i}"] is not None])
        for c in columns
    }


STEPS = 4096  # bins per factor of e in a weighted bracket


def weighted_brackets(df: DataFrame, column: str, weight: str, quantiles: list[float]) -> Brackets:
    """As :func:`rank_brackets`, for rows that count ``weight`` times.

    Values are binned by their logarithm, 4096 bins for each factor of e; the weights of the
    bins tell exactly which bins hold the wanted ranks. One scan with map-side combining. There
    are at most 5.8 million bins for any doubles, 46,000 for seconds of a day, so one task can
    sum over them; only two numbers per quantile reach the driver.
    """
    v = F.col(column).cast("double")
    step = F.floor(F.signum(v) * F.log1p(F.abs(v)) * STEPS)
    bins = (
        df.select(v.alias("_v"), F.col(weight).alias("_w"), step.alias("_step")).where("_v IS NOT NULL").groupBy("_step")
        .agg(F.sum("_w").alias("_in"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    order = Window.orderBy("_step")
    total = bins.withColumn("_upto", F.sum("_in").over(order)).withColumn("_n", F.sum("_in").over(Window.partitionBy()))
    ends = []
    for i, q in enumerate(quantiles):
        rank = F.lit(float(q)) * (F.col("_n") - 1)
        holds = (F.col("_upto") > F.floor(rank)) & (F.col("_upto") - F.col("_in") <= F.ceil(rank))
        ends += [F.min(F.when(holds, F.col("_low"))).alias(f"low{i}"), F.max(F.when(holds, F.col("_high"))).alias(f"high{i}")]
    row = total.agg(*ends).first()
    return _merged([(row[f"low{i}"], row[f"high{i}"]) for i in range(len(quantiles)) if row[f"low{i}"] is not None])


def _merged(pairs: Brackets) -> Brackets:
    out: Brackets = []
    for lo, hi in sorted(pairs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _gaps(brackets: Brackets) -> list[float]:
    """One stand-in value for everything before, between and after the brackets."""
    inner = [(a[1] + b[0]) / 2 for a, b in zip(brackets, brackets[1:])]
    return [float("-inf"), *inner, float("inf")]


def _outside_as_gap(value: Column, brackets: Brackets) -> Column:
    if not brackets:
        return value
    out = None
    for (lo, hi), before in zip(brackets, _gaps(brackets)):
        # In order: still before this bracket, or inside it.
        out = F.when(value < lo, F.lit(before)) if out is None else out.when(value < lo, F.lit(before))
        out = out.when(value <= hi, value)
    return out.when(value.isNotNull(), F.lit(float("inf")))


def value_table(
    df: DataFrame,
    columns: list[str],
    brackets: dict[str, Brackets] | None = None,
    parts: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Several numeric columns as a stored (column, value, cnt) table, bucketed along column and value.

    One scan with map-side combining; NULLs are left out. Every order statistic and every
    moment of the columns can be read from this table instead of the data.

    With ``brackets`` (see :func:`rank_brackets`) only values inside a bracket are kept
    apart; the rest is counted per gap. That leaves little to shuffle for a column in which
    almost every value is different, and the wanted quantiles are still exact. A row counts
    as often as its column ``weight`` says, once without one.
    """
    brackets = brackets or {}
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    long = (
        df.select(times.alias("_times"), *[_outside_as_gap(F.col(c).cast("double"), brackets.get(c, [])).alias(c) for c in columns])
        .unpivot(["_times"], columns, "column", "value")
        .where("value IS NOT NULL")
    )
    counts = long.groupBy("column", "value").agg(F.sum("_times").alias("cnt"))
    return bucketed(counts, ["column", "value"], parts, "value-counts")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    quantiles: list[float],
    parts: int | None = None,
    continuous: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of several numeric columns, of rows that count ``weight`` times if given.

    One scan; with ``continuous`` (mostly different values) a second one, which saves the
    shuffle of all values.
    """
    brackets = None
    if continuous:
        weighted = lambda: {c: weighted_brackets(df, c, weight, quantiles) for c in columns}
        brackets = rank_brackets(df, columns, quantiles) if weight is None else weighted()
    return quantiles_of(value_table(df, columns, brackets, parts, weight), quantiles, brackets)


def quantiles_of(counts: DataFrame, quantiles: list[float], brackets: dict[str, Brackets] | None = None) -> DataFrame:
    """Quantiles from a :func:`value_table`.

    Returns one row per column: ``column``, ``n`` (non-null values) and ``q``, an array in
    the order of ``quantiles``; a column without values has no row. Only the buckets that
    hold a wanted rank are sorted.
    """

    def ranks(q: float) -> tuple[Column, Column, Column]:
        pos = F.lit(float(q)) * (F.col("n") - 1)
        return pos, F.floor(pos), F.ceil(pos)

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (start <= rank) & (rank < start + size)

    per_column = Window.partitionBy("column")
    below = per_column.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A row per bucket, and one more for each column that begins inside it.
    totals = (
        counts.groupBy("column", "_bucket")
        .agg(F.sum("cnt").alias("_in"))
        .select(
            F.col("column").alias("_column"),
            F.col("_bucket").alias("_b"),
            "_in",
            F.coalesce(F.sum("_in").over(below), F.lit(0)).alias("_base"),
            F.sum("_in").over(per_column).alias("n"),
        )
    )
    wanted = F.lit(False)
    for q in quantiles:
        for rank in ranks(q)[1:]:
            wanted = wanted | holds(rank, F.col("_base"), F.col("_in"))
    inside = F.sum("cnt").over(
        Window.partitionBy("column", "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counts.join(
        F.broadcast(totals.where(wanted)),
        (F.col("column") == F.col("_column")) & (F.col("_bucket") == F.col("_b")),
    ).withColumn("_start", F.col("_base") + inside - F.col("cnt"))

    # A wanted rank must meet a real value, never the stand-in of a gap.
    value = F.col("value")
    for name, spans in (brackets or {}).items():
        gap = (F.col("column") == name) & F.col("value").isin(_gaps(spans))
        value = F.when(gap, F.raise_error(F.lit(f"quantile of {name} outside its bracket")).cast("double")).otherwise(value)
    picks = []
    for i, q in enumerate(quantiles):
        _, lo, hi = ranks(q)
        for tag, rank in (("lo", lo), ("hi", hi)):
            hit = holds(rank, F.col("_start"), F.col("cnt"))
            picks.append(F.max(F.when(hit, value)).alias(f"_{tag}{i}"))
    picked = ranked.groupBy("column", "n").agg(*picks)

    def interpolate(i: int, q: float) -> Column:
        pos, floor, _ = ranks(q)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return low + (high - low) * (pos - floor)

    return picked.select(
        "column", "n", F.array(*[interpolate(i, q) for i, q in enumerate(quantiles)]).alias("q")
    )


def quantile_row(
    df: DataFrame, column: str, named: dict[str, float], continuous: bool = False, weight: str | None = None
) -> DataFrame:
    """One row with a named column per quantile; NULLs when there are no values."""
    return _as_row(exact_quantiles(df, [column], list(named.values()), continuous=continuous, weight=weight), named)


def quantile_row_of(counts: DataFrame, named: dict[str, float]) -> DataFrame:
    """As :func:`quantile_row`, from a value table of a single column."""
    return _as_row(quantiles_of(counts, list(named.values())), named)


def _as_row(q: DataFrame, named: dict[str, float]) -> DataFrame:
    return q.agg(*[F.max(F.get("q", F.lit(i))).alias(name) for i, name in enumerate(named)])


def moments_of(counts: DataFrame) -> DataFrame:
    """n, min, max, mean and sample standard deviation per column of a value table.

    The deviation is summed around the mean, which is broadcast: one row per column.
    """
    v, w = F.col("value"), F.col("cnt")
    first = counts.groupBy("column").agg(
        F.sum(w).alias("n"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        exact_mean(F.struct(*exact_parts(v, "x", weight=w))).alias("mean"),
    )
    centred = counts.join(F.broadcast(first.select(F.col("column").alias("_c"), "mean")), F.col("column") == F.col("_c"))
    spread = centred.groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(w * (v - F.col("mean")) ** 2), F.sum(w).cast("double") - 1)).alias("stddev")
    )
    return first.join(spread, "column")
