"""Trees grown from packed blocks, against Spark's own fit, plain sums and the limits of a block."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from stayline.operators import growing, model
from stayline.schemas import CATEGORICAL_FEATURES, FEATURES
from stayline.session import stage


def rows_of(spark, n, partitions=3):
    """Features of few values, with NULLs and values on both sides of -1, and labels that follow some of them."""
    pick = lambda i, m: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m)).cast("int")
    columns = [(F.when(pick(i, 100) < 10 + i, None).otherwise(pick(50 + i, 4 + i % 5) - (3 if i == 9 else 0))).cast("int").alias(c) for i, c in enumerate(FEATURES)]
    churn = (F.coalesce(F.col("n_txn"), F.lit(5)) + F.coalesce(F.col("registered_via"), F.lit(0)) * 2 + pick(98, 9) > 11) | (pick(99, 8) == 0)
    return spark.range(0, n, 1, partitions).select("id", *columns).select("*", F.lit("train").alias("split"), churn.cast("int").alias("is_churn"))


def spark_fit(rows, weight, rounds, depth):
    weighted = model.encode(rows).select("*", F.col("is_churn").cast("double").alias("label"), F.when(F.col("is_churn") == 1, weight).otherwise(1.0).alias("weight"))
    gbt = GBTClassifier(
        labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=model.STEP_SIZE,
        minInstancesPerNode=model.MIN_LEAF_ROWS, subsamplingRate=1.0, featureSubsetStrategy="all", seed=1,
    )
    return Pipeline(stages=[*model._assembly()[0], gbt]).fit(weighted)


def test_trees_are_those_of_spark(spark, monkeypatch):
    """With all rows and features in every tree nothing is drawn, and features of few values are cut alike."""
    rows = stage(rows_of(spark, 4000), "plain")
    want = spark_fit(rows, 0.7, 4, 4)
    monkeypatch.setattr(growing, "HERE_ROWS", 0)
    monkeypatch.setattr(model, "ROW_SHARE", 1.0)
    monkeypatch.setattr(model, "FEATURE_SHARE", "1.0")
    got = model.fit_gbt(rows, scale_pos_weight=0.7, rounds=4, depth=4)
    a, b = ({r.id: r.score for r in model.score(rows, m).select("id", "score").collect()} for m in (got, want))
    assert len(a) == 4000 and max(abs(a[i] - b[i]) for i in a) < 1e-6
    x, y = ({r.feature: r.importance for r in model.feature_importance(m, rows).collect()} for m in (got, want))
    assert x == pytest.approx(y, abs=1e-4)
    for t, u in zip(got.stages[-1].trees, want.stages[-1].trees):
        assert (t.numNodes, t.depth) == (u.numNodes, u.depth)
        one, other = t._java_obj.rootNode(), u._java_obj.rootNode()
        assert one.impurity() == pytest.approx(other.impurity(), abs=1e-4) and one.gain() == pytest.approx(other.gain(), abs=1e-6)
        assert one.impurityStats().count() == pytest.approx(other.impurityStats().count())
        assert one.leftChild().impurity() == pytest.approx(other.leftChild().impurity(), abs=1e-4)


def test_the_fit_does_not_sum_every_feature_of_every_row(spark, monkeypatch):
    """Spark's own fit does, for each level of each tree."""
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *_: pytest.fail("Spark's own fit"))
    monkeypatch.setattr(growing, "HERE_ROWS", 0)
    seen = []
    first = growing.grow

    def grow(sums, layout, params, round_):
        def counted(tree, nodes):
            cells = sums(tree, nodes)
            seen.append((round_, tree, nodes, [int(c[:, 0, : layout.sizes[0]].sum()) for c in cells]))
            return cells

        assert len(layout.packs) < layout.features / 2
        return first(counted, layout, params, round_)

    monkeypatch.setattr(growing, "grow", grow)
    model.fit_gbt(stage(rows_of(spark, 3000), "sums"), rounds=2, depth=4)
    for round_ in (0, 1):
        own = [s for s in seen if s[0] == round_]
        (root,) = own[0][3]
        assert len(own) <= 4 and 0.75 * 3000 < root < 0.85 * 3000  # one sum a level, over the tree's rows
        assert own[0][2] == [0] and all(2 * sum(s[3]) <= root for s in own[1:])


def test_a_fit_is_the_same_however_blocks_are_dealt(spark, monkeypatch):
    """One task with all blocks, jobs over all blocks, and jobs for one node each give the same trees, to the last bit."""
    monkeypatch.setattr(growing, "CHECKPOINT_EVERY", 2)
    rows = stage(rows_of(spark, 4000, 7), "dealt")
    found = []
    for here, nodes in ((4000, 256), (0, 256), (0, 1)):
        monkeypatch.setattr(growing, "HERE_ROWS", here)
        monkeypatch.setattr(growing, "NODES_A_JOB", nodes)
        fit = model.fit_gbt(rows, rounds=5, depth=3).stages[-1]
        found.append((fit.toDebugString.split("\n", 1)[1], [t._java_obj.rootNode().leftChild().impurity() for t in fit.trees]))
    assert found[0] == found[1] == found[2]
    assert found[0][0] != model.fit_gbt(rows, rounds=5, depth=3, seed=7).stages[-1].toDebugString.split("\n", 1)[1]


LAYOUT = growing.Layout(((-1.0, 0.5, 2.0), (-3.0, -1.0)), (3, 40), -1.0)


def block(codes, key=1, positive=True):
    return key, positive, codes.shape[1], codes.tobytes()


def test_packed_codes_and_splits_agree_with_the_vector(spark):
    """What a split sends left in a block is what Spark sends left in the assembled vector."""
    rng, n = np.random.default_rng(5), 700
    null = rng.random(n) < 0.2
    a, b = np.where(null, -1.0, rng.choice([-2.0, -1.0, 0.0, 1.0, 2.0, 3.0], n)), rng.choice([-4.0, -3.0, -2.0, 0.0], n)
    c, d = rng.integers(0, 3, n), rng.integers(0, 40, n)
    rows = [(None if gone else x, *others, 1.0) for gone, x, *others in zip(null.tolist(), a.tolist(), b.tolist(), c.tolist(), d.tolist())]
    df = spark.createDataFrame(rows, "a double, b double, c int, d int, label double").coalesce(1)
    made = df.mapInArrow(lambda it: growing.pack_rows(it, LAYOUT), "key bigint, positive boolean, n int, codes binary").collect()
    codes = np.concatenate([np.frombuffer(r.codes, np.uint8).reshape(-1, r.n) for r in made], axis=1)
    assert codes.shape == (len(LAYOUT.packs), n) and all(r.positive for r in made)
    cases = [(0, (0,), a <= -1.0), (0, (0, 1), a <= 0.5), (1, (0,), b <= -3.0), (2, (0,), ~null), (4, (2, 0), np.isin(c, (0, 2))), (5, (7, 31), np.isin(d, (7, 31)))]
    for feature, bins, want in cases:
        tree = growing.Tree({0: growing.Split(feature, bins, 1.0, (1, 2))}, [np.zeros((2, 2))] * 3)
        assert (growing.Walk(tree, LAYOUT).nodes(codes) == np.where(want, 1, 2)).all()


def test_deep_walks_and_many_nodes(spark):
    """Masked levels, levels by row, and trees of more nodes than a byte holds lead to the same leaves."""
    rng = np.random.default_rng(3)
    codes = np.stack([rng.integers(0, np.prod([LAYOUT.sizes[f] for f in p]), 3000).astype(np.uint8) for p in LAYOUT.packs])

    def grown(depth):
        tree = growing.Tree({}, [None])
        for _ in range(depth):
            for node in [n for n in range(len(tree.totals)) if n not in tree.splits]:
                tree.splits[node] = growing.Split(5, tuple(rng.choice(40, 20, replace=False)), 1.0, (len(tree.totals), len(tree.totals) + 1))
                tree.totals += [None, None]
        return tree

    for depth in (2, 5, 9):
        tree = grown(depth)
        want = np.zeros(3000, int)
        for _ in range(depth):
            for node in set(want):
                split = tree.splits.get(node)
                if split:
                    at = want == node
                    pack = next(i for i, p in enumerate(LAYOUT.packs) if LAYOUT.field_of(5) in p)
                    want[at] = np.where(LAYOUT.goes_left(5, np.array(split.bins))[codes[pack][at]], *split.children)
        assert (growing.Walk(tree, LAYOUT).nodes(codes) == want).all() and len(set(want)) >= min(2**depth, 20)


def test_short_blocks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(growing, "BLOCK", 10)
    rng = np.random.default_rng(1)
    rows = [(k, bool(k % 2), n, rng.integers(0, 9, (3, n)).astype(np.uint8)) for k, n in ((7, 4), (3, 10), (1, 5), (4, 6), (9, 2), (2, 3))]
    df = spark.createDataFrame([(k, p, n, bytearray(c.tobytes())) for k, p, n, c in rows], "key bigint, positive boolean, n int, codes binary")
    place, joined, total = growing.places(df)
    assert (joined, total) == (4, 30)
    got = sorted(growing.dealt(df, place, joined).collect())
    codes = {k: c for k, _, _, c in rows}
    want = [(1, True, 5, [1]), (2, False, 9, [2, 4]), (3, True, 10, [3]), (7, True, 6, [7, 9])]
    assert got == [(k, p, n, np.concatenate([codes[j] for j in parts], axis=1).tobytes()) for k, p, n, parts in want]


def test_sums_of_full_blocks_are_exact():
    n = growing.BLOCK
    codes = np.zeros((len(LAYOUT.packs), n), np.uint8)
    q = np.full(n, growing.LARGEST, np.uint32)
    walk = growing.Walk(growing.Tree(totals=[None]), LAYOUT)
    pairs = [(block(codes, k, k < 3), (k < 3, q.tobytes(), None)) for k in range(4)]
    ((cells, _),) = growing.sums_of_task(iter(pairs), walk, [0], LAYOUT)
    first = np.cumsum([0, *LAYOUT.sizes[:-1]])
    for label, times in ((1, 3), (0, 1)):
        assert (cells[label, 0, 0, first] == times * n).all() and (cells[label, 1, 0, first] == times * n * growing.LARGEST).all()
        assert cells[label, 0, 0].sum() == len(LAYOUT.sizes) * times * n


def test_residuals_stay_in_their_range_and_rows_are_drawn_anew():
    margin = np.array([-1e4, -3.0, 0.0, 3.0, 1e4])
    q = growing.residuals(1, True, margin, 3, 1.0, 0)
    want = 4 / (1 + np.exp(np.minimum(2 * margin, 700.0)))
    assert q[0] == growing.LARGEST and np.abs(q[1:] / growing.UNIT - want[1:]).max() < 1e-6
    assert (growing.residuals(1, False, -margin, 3, 1.0, 0) == q).all()
    drawn = [growing.residuals(k, True, np.zeros(20000), r, 0.8, 42) != growing.LEFT_OUT for k, r in ((1, 1), (1, 2), (2, 1))]
    assert all(0.79 < d.mean() < 0.81 for d in drawn) and all((a != b).mean() > 0.2 for a, b in zip(drawn, drawn[1:]))
    assert (growing.residuals(1, True, np.zeros(20000), 1, 0.8, 42) != growing.LEFT_OUT).tolist() == drawn[0].tolist()


def test_bad_rows_fail(spark):
    rows = rows_of(spark, 200)
    for bad, said in (
        (rows.withColumn("tenure_days", F.lit("NaN").cast("double")), "NaN"),
        (rows.withColumn("is_churn", F.when(F.col("id") != 7, F.col("is_churn"))), "NULL"),
        (rows.withColumn("registered_via", F.col("id")), "more than 32"),
    ):
        with pytest.raises(Exception, match=said):
            model.fit_gbt(stage(bad, "bad"), rounds=1, depth=1)


def test_features_without_a_choice_are_never_split(spark):
    rows = rows_of(spark, 1500)
    for c in FEATURES[2:]:
        rows = rows.withColumn(c, F.lit(None).cast("int") if c in CATEGORICAL_FEATURES or c == "log_days" else F.lit(3))
    fit = model.fit_gbt(stage(rows, "few"), rounds=2, depth=3)
    used = {r.feature for r in model.feature_importance(fit, rows).collect() if r.importance > 0}
    assert used and used <= set(FEATURES[:2])
