"""Boosted trees: equal to a plain fit, missing values, categories, any partitioning."""

import math

import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting
from stayline.operators.boosting import Boosting, UNIT
from stayline.session import stage

NAMES, KINDS = ["a", "b", "kind"], ["kind"]
PARAMS = Boosting(rounds=3, depth=3, bins=8, step=0.3, min_rows=5)


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt, n: F.pmod(F.hash("id", F.lit(salt)), F.lit(n))
    made = spark.range(900).select(
        "id",
        F.when(h(1, 6) > 0, h(2, 50) / 4).alias("a"),
        F.when(h(3, 4) > 0, h(4, 9).cast("double")).otherwise(F.lit(float("nan"))).alias("b"),
        F.when(h(5, 9) > 0, h(6, 7).cast("int")).alias("kind"),
        F.when(F.col("id") < 600, "train").when(F.col("id") < 750, "val").otherwise("test").alias("split"),
    )
    logit = F.when(F.col("a").isNull(), 2).otherwise(F.col("a") / 8 - 1) + F.when(F.col("kind").isin(1, 4, 6), 1.5).otherwise(-1)
    return stage(made.withColumn("is_churn", (logit + h(7, 100) / 40 - 1.25 > 0).cast("int")), "boosting")


def plain_fit(data, bins, params, weight):
    """Row by row: sums of every candidate from scratch."""
    margins, trees = [0.0] * len(data), []
    for _ in range(params.rounds):
        grads = []
        for (_, y), m in zip(data, margins):
            p, w = 1 / (1 + math.exp(-m)), weight if y else 1.0
            grads.append((math.floor((p - y) * w * UNIT + 0.5), math.floor(p * (1 - p) * w * UNIT + 0.5)))
        tree, nodes = {}, [1] * len(data)
        for level in range(params.depth):
            for node in range(1 << level, 2 << level):
                own = [i for i, n in enumerate(nodes) if n == node]
                best = None
                for f in range(len(bins.features)):
                    total = [sum(grads[i][k] for i in own) / UNIT for k in (0, 1)]
                    seen = sorted({data[i][0][f] for i in own} - {-1})
                    if f in bins.categories:
                        sums = {b: [sum(grads[i][k] for i in own if data[i][0][f] == b) / UNIT for k in (0, 1)] for b in seen}
                        seen.sort(key=lambda b: (sums[b][0] / (sums[b][1] + params.l2), b))
                    for k in range(len(seen)):
                        for missing_left in (False, True):
                            go = set(seen[: k + 1]) | ({-1} if missing_left else set())
                            left = [i for i in own if data[i][0][f] in go]
                            if min(len(left), len(own) - len(left)) < params.min_rows:
                                continue
                            g, h = (sum(grads[i][j] for i in left) / UNIT for j in (0, 1))
                            rg, rh = total[0] - g, total[1] - h
                            score = lambda g, h: g * g / (h + params.l2)
                            gain = score(g, h) + score(rg, rh) - score(*total)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                values = tuple(-params.step * x / (y + params.l2) for x, y in ((g, h), (rg, rh)))
                                best = (gain, f, tuple(seen[: k + 1]), missing_left, values)
                if best:
                    tree[node] = best
            for i, n in enumerate(nodes):
                if n in tree and n >= 1 << level:
                    _, f, left, missing_left, _ = tree[n]
                    b = data[i][0][f]
                    known = b in left if f in bins.categories else 0 <= b <= max(left)
                    nodes[i] = 2 * n + (0 if known or (b == -1 and missing_left) else 1)
        trees.append(tree)
        for i, n in enumerate(nodes):
            margins[i] += tree[n // 2][4][n % 2]
    return trees, margins


def test_equals_a_plain_fit(spark, rows):
    train = rows.where("split <> 'val'").withColumn("split", F.lit("train"))
    model = boosting.fit_boosted(train, PARAMS, NAMES, KINDS, scale_pos_weight=1.75)
    binned = boosting._binned(train.orderBy("id"), model.bins, F.col("is_churn"), F.col("id")).orderBy("id").collect()
    data = [(list(r["_bins"]), r.is_churn) for r in binned]
    trees, margins = plain_fit(data, model.bins, PARAMS, 1.75)
    assert len(model.trees) == 3
    for got, want in zip(model.trees, trees):
        assert {n: (s.feature, s.left, s.missing_left) for n, s in got.items()} == {n: w[1:4] for n, w in want.items()}
        for n, s in got.items():
            assert (s.gain, s.left_value, s.right_value) == pytest.approx((want[n][0], *want[n][4]), abs=1e-9)
    scores = [r.score for r in boosting.score_boosted(train, model).orderBy("id").collect()]
    assert scores == pytest.approx([1 / (1 + math.exp(-m)) for m in margins], abs=1e-12)


def test_bins_of_values(spark, rows):
    bins = boosting.find_bins(rows.where("split = 'train'"), NAMES, KINDS, 8)
    for r, got in zip(rows.orderBy("id").collect(), boosting._binned(rows.orderBy("id"), bins, F.col("id")).orderBy("id").collect()):
        a, b, kind = got["_bins"]
        assert a == (-1 if r.a is None else sum(e < r.a for e in bins.edges[0]))
        assert b == (-1 if math.isnan(r.b) else sum(e < r.b for e in bins.edges[1]))
        assert kind == (-1 if r.kind is None else bins.edges[2].index(r.kind))
    unseen = rows.limit(1).withColumn("kind", F.lit(99))
    assert boosting._binned(unseen, bins).first()["_bins"][2] == -1


def test_any_partitioning_gives_the_same_model(rows):
    one, many = (boosting.fit_boosted(rows.repartition(n), PARAMS, NAMES, KINDS) for n in (1, 7))
    assert one == many and one.trees


def test_of_two_children_the_smaller_is_summed(rows, monkeypatch):
    asked, summed, siblings = [], boosting.level_sums, boosting.with_siblings

    def level_sums(rows, node, nodes):
        asked.append((rows, node, nodes))
        return summed(rows, node, nodes)

    def with_siblings(sums, nodes, parents):
        rows, node, _ = asked[-1]
        every = sorted(nodes + [n ^ 1 for n in nodes])
        want = summed(rows, node, every).toPandas()
        got = siblings(sums, nodes, parents)
        assert sorted(got.itertuples(index=False, name=None)) == sorted(want.itertuples(index=False, name=None))
        assert set(got.dtypes[["g", "h", "n"]].map(str)) == {"int64"}
        return got

    monkeypatch.setattr(boosting, "level_sums", level_sums)
    monkeypatch.setattr(boosting, "with_siblings", with_siblings)
    train = rows.where("split = 'train'").withColumn("is_churn", F.when(F.col("id") % 50 == 0, 1).otherwise(F.col("is_churn")))
    model = boosting.fit_boosted(train, Boosting(rounds=1, depth=3, bins=8, min_rows=5), NAMES, KINDS)
    levels = [nodes for *_, nodes in asked]
    assert levels[0] == [1] and len(levels) == 3 and all(levels)
    assert [sorted(n // 2 for n in nodes) for nodes in levels[1:]] == [sorted(n for n in model.trees[0] if n.bit_length() == k) for k in (1, 2)]
    for n in levels[1] + levels[2]:
        split = model.trees[0][n // 2]
        assert (split.n_left, split.n_right)[n % 2] == min(split.n_left, split.n_right)


def test_missing_values_choose_their_side(spark):
    data = [(None if i % 3 == 0 else float(i % 10), int(i % 3 == 0 or i % 10 > 6), "train") for i in range(300)]
    rows = spark.createDataFrame(data, "a double, is_churn int, split string")
    model = boosting.fit_boosted(rows, Boosting(rounds=1, depth=1, bins=8), ["a"], [])
    (split,) = model.trees[0].values()
    assert not split.missing_left and split.left_value < 0 < split.right_value  # with the large values
    flipped = boosting.fit_boosted(rows.withColumn("a", -F.col("a")), Boosting(rounds=1, depth=1, bins=8), ["a"], [])
    assert flipped.trees[0][1].missing_left
    shares = boosting.gain_shares(rows, model).collect()
    assert [(r.feature, r.importance) for r in shares] == [("a", 1.0)]


def test_nothing_to_learn(spark, rows):
    flat = rows.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(1.0)).withColumn("kind", F.lit(2))
    model = boosting.fit_boosted(flat, PARAMS, NAMES, KINDS)
    assert model.trees == [] and {r.score for r in boosting.score_boosted(flat, model).collect()} == {0.5}
    assert boosting.fit_boosted(rows.limit(0), PARAMS, NAMES, KINDS).trees == []
    assert boosting.splits_table(flat, model).count() == 0
    assert boosting.score_boosted(rows.limit(0), boosting.fit_boosted(rows, PARAMS, NAMES, KINDS)).count() == 0


def test_rounds_stop_on_the_val_split(rows):
    from stayline.operators.ranking import ranking_metrics

    whole = boosting.fit_boosted(rows.where("split <> 'val'"), PARAMS, NAMES, KINDS)
    val = rows.where("split = 'val'")
    best = []
    for n in range(1, len(whole.trees) + 1):
        part = boosting.BoostedModel(whole.bins, whole.trees[:n])
        best.append(ranking_metrics(boosting.score_boosted(val.withColumn("msno", F.col("id").cast("string")), part)).first().auc_pr)
    assert len(boosting.fit_boosted(rows, PARAMS, NAMES, KINDS).trees) == 1 + max(range(len(best)), key=lambda i: (best[i], -i))


def test_too_many_categories(spark):
    rows = spark.range(2000).select(F.col("id").alias("kind"), (F.col("id") % 2).alias("is_churn"), F.lit("train").alias("split"))
    with pytest.raises(ValueError, match="too many"):
        boosting.fit_boosted(rows, PARAMS, ["kind"], ["kind"])
