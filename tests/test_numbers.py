import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.functions import dates
from stayline.functions.numbers import percent, ratio, round_half_away, unit_mean
from stayline.operators.running import exact_quantiles, quantile_row, rank_brackets, value_table


@pytest.mark.parametrize("digits", [0, 1, 2, 4])
def test_rounding_matches_the_oracle_engine(spark, digits):
    rng = np.random.default_rng(1)
    values = [float(v) for v in np.concatenate([rng.normal(0, 100, 400), rng.integers(-999, 999, 200) / 1000])]
    values += [0.285, 1.005, -0.285, 2.5, -2.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_half_away(F.col("x"), digits)).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, ?)", [v, digits]).fetchone()[0] for v in values]
    assert got == want


def test_ratio_and_percent(spark):
    row = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)).alias("r"), percent(F.lit(1), F.lit(3), 2).alias("p"), percent(F.lit(1), F.lit(0)).alias("z")
    ).first()
    assert (row.r, row.p, row.z) == (None, 33.33, None)


def test_mean_does_not_depend_on_row_order(spark):
    """A mean on a rounding tie, added up in many orders and partitions."""
    from fractions import Fraction

    rng = np.random.default_rng(4)
    parts = [(1, 3), (2, 7), (1, 9), (5, 11), (0, 4), (3, 13), (1, 6), (2, 3)] * 3
    rest = Fraction(20625, 100000) * 25 - sum(Fraction(a, b) for a, b in parts)
    values = [a / b for a, b in parts] + [float(rest) % 1]
    results = set()
    for _ in range(6):
        order = [values[i] for i in rng.permutation(len(values))]
        df = spark.createDataFrame([(v,) for v in order] + [(None,)], "x double").repartition(int(rng.integers(1, 9)))
        results.add(df.agg(unit_mean(F.col("x"))).first()[0])
    assert len(results) == 1
    assert results.pop() == pytest.approx(float(sum(map(Fraction, values)) / len(values)), rel=1e-15)
    assert spark.createDataFrame([(None,)], "x double").agg(unit_mean(F.col("x"))).first()[0] is None


def test_dates(spark):
    df = spark.createDataFrame([(20170228,), (None,)], "x int")
    assert [r[0] for r in df.select(dates.int_to_date("x")).collect()] == [dt.date(2017, 2, 28), None]
    bad = spark.createDataFrame([(20170230,)], "x int")
    assert bad.select(dates.try_int_to_date("x")).first()[0] is None
    with pytest.raises(Exception, match="DATE|date"):
        bad.select(dates.int_to_date("x")).collect()
    assert dates.month_bounds("2016-02") == (20160201, 20160229)
    assert dates.shift_int(20170331, 30) == 20170430
    assert dates.as_date(dt.datetime(2017, 3, 1, 5)) == dates.as_date("2017-03-01T00:00") == dt.date(2017, 3, 1)
    for bad_month in ("2017-3", "2017-00", "201703"):
        with pytest.raises(ValueError):
            dates.month_bounds(bad_month)


@pytest.mark.parametrize("parts", [1, 37])
def test_exact_quantiles(spark, parts):
    """One bucket or many: the same exact values, with a hot value and NULLs."""
    rng = np.random.default_rng(3)
    n = 900
    a = np.where(np.arange(n) % 3 == 0, 7.25, rng.normal(0, 50, n))  # a third is one value
    b = rng.integers(0, 5, n).astype(float)
    rows = [(float(x), None if i % 10 == 0 else float(y), None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r.column: r for r in exact_quantiles(df, ["a", "b", "c"], qs, parts).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].n == n and got["b"].n == n - 90
    assert got["a"].q == pytest.approx(np.quantile(a, qs).tolist(), abs=1e-9)
    kept = [y for i, y in enumerate(b) if i % 10]
    assert got["b"].q == pytest.approx(np.quantile(kept, qs).tolist(), abs=1e-9)


@pytest.mark.parametrize("shape", ["random", "sorted", "hot", "tiny", "constant", "halves"])
def test_bracketed_quantiles_are_exact(spark, shape):
    """Also when every task sees a different range of values."""
    rng = np.random.default_rng(9)
    n = {"tiny": 3}.get(shape, 20_000)
    x = rng.lognormal(3, 2, n)
    if shape == "sorted":
        x = np.sort(x)
    elif shape == "hot":
        x[: n // 3] = 42.0
    elif shape == "constant":
        x[:] = 5.0
    elif shape == "halves":
        x = np.concatenate([rng.normal(0, 1, n // 2), rng.normal(1e6, 1, n - n // 2)])
    df = spark.createDataFrame([(float(v), float(i) if i % 2 else None) for i, v in enumerate(x)], "x double, y double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r.column: r for r in exact_quantiles(df, ["x", "y"], qs, continuous=True).collect()}
    assert got["x"].n == n
    assert got["x"].q == pytest.approx(np.quantile(x, qs).tolist(), abs=1e-9, rel=1e-12)
    odd = np.arange(n)[np.arange(n) % 2 == 1].astype(float)
    assert got["y"].q == pytest.approx(np.quantile(odd, qs).tolist(), abs=1e-9, rel=1e-12)


def test_brackets_keep_few_values(spark):
    df = spark.range(200_000).select((F.xxhash64("id") % 10**9).cast("double").alias("x"))
    brackets = rank_brackets(df, ["x"], [0.99])
    plain = value_table(df, ["x"]).count()
    kept = value_table(df, ["x"], brackets).count()
    assert plain > 190_000 and kept < plain / 20


def test_quantile_row_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantile_row(df, "x", {"m": 0.5}).first().m is None
    assert quantile_row(df, "x", {"m": 0.5}, continuous=True).first().m is None


def test_weighted_quantiles_equal_repeated_rows(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    values = np.concatenate((rng.exponential(3000, 400), -rng.random(50), [0.0, 0.0, 86400.0, 86400.0]))
    times = rng.integers(1, 90, len(values))
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, times)] + [(None, 5)], "x double, w bigint").repartition(5)
    whole, wanted = np.repeat(values, times), [0.0, 0.01, 0.5, 0.99, 1.0]
    for continuous in (True, False):
        (row,) = exact_quantiles(df, ["x"], wanted, continuous=continuous, weight="w").collect()
        assert row.n == len(whole) and row.q == pytest.approx(np.quantile(whole, wanted).tolist(), abs=1e-9)
    assert exact_quantiles(df.limit(0), ["x"], wanted, continuous=True, weight="w").count() == 0
