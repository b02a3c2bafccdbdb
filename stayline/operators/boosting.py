"""Gradient-boosted trees over binned columns: missing values and categories are split, not encoded.

Every feature is cut into few bins once. A tree grows level by level from one grouped sum of
gradients per (node, feature, bin), which combines before its shuffle and whose size does not
depend on the rows; of two children one is summed, the other has the rest. A numeric feature is cut between two of its bins, a category by a set of
its values (ordered by gradient, so the best set is among the prefixes); either way both
sides are tried for the rows without a value, and the better one is kept. Those sums, at most
nodes x features x bins of them, are all that reaches the driver.

Gradients are summed as integers of ``1 / UNIT``, so a fit is the same for any order,
partitioning or retry of its tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from stayline.operators.checks import in_unit_interval
from stayline.operators.labels import class_ratio
from stayline.operators.model import MIN_LEAF_ROWS, STEP_SIZE, best_prefix
from stayline.operators.ranking import average_precision_by
from stayline.operators.running import running_sums
from stayline.schemas import CATEGORICAL_FEATURES, FEATURES, require_columns
from stayline.session import stage

UNIT = 1 << 20  # gradients per row are below the class weight, so sums of 10^11 rows fit a long
MISSING = -1
LEAST_GAIN = 1e-6
MOST_CATEGORIES = 1_024
STAGED_EVERY = 5  # trees whose leaves are added up in one expression


@dataclass(frozen=True)
class Boosting:
    rounds: int = 100
    depth: int = 4
    bins: int = 32
    step: float = STEP_SIZE
    l2: float = 1.0
    min_rows: int = MIN_LEAF_ROWS
    patience: int = 50


@dataclass(frozen=True)
class Split:
    """Rows of ``left`` bins go to the node's left child; rows without a value go where ``missing_left`` says."""

    feature: int
    left: tuple[int, ...]
    missing_left: bool
    gain: float
    n_left: int
    n_right: int
    left_value: float
    right_value: float


@dataclass(frozen=True)
class Bins:
    """Ascending cuts of each numeric feature, and ascending known values of each category."""

    features: tuple[str, ...]
    categories: frozenset[int]
    edges: tuple[tuple[float, ...], ...]

    def column(self, i: int) -> Column:
        """Bin of a value: cuts below it, or its place among the known categories."""
        name = self.features[i]
        x = F.col(f"`{name}`").cast("double")
        edges = F.lit(np.array(self.edges[i], dtype=np.float64)) if self.edges[i] else F.array().cast("array<double>")
        if i in self.categories:
            found = F.array_position(edges, x).cast("int") - 1
        else:
            found = F.size(F.filter(edges, lambda e: e < x))
        return F.when(x.isNull() | F.isnan(x), MISSING).otherwise(found).cast("smallint")


@dataclass
class BoostedModel:
    """``trees``: the split of each inner node; the root is 1, the children of n are 2n and 2n + 1."""

    bins: Bins
    trees: list[dict[int, Split]] = field(default_factory=list)


def find_bins(train: DataFrame, features: list[str], categories: list[str], bins: int) -> Bins:
    """Cuts at values where a numeric feature's running count passes a ``bins``-th of its rows; all values of a category."""
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in features}
    edges: dict[str, list[float]] = {}
    numeric, present = ([c for c in features if (c in categories) == of_category] for of_category in (False, True))
    if numeric:
        cast = train.select(*[values[c].alias(c) for c in numeric])
        counts = stage(cast.unpivot([], numeric, "column", "value").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")), "boost-values")
        totals = counts.groupBy("column").agg(F.sum("cnt").alias("n"))  # a row per feature
        # ``cum_cnt`` counts the values from this one up.
        running = running_sums(counts, "value", ["cnt"], by=["column"]).join(F.broadcast(totals), "column")
        passes = F.expr(f"((n - cum_cnt + cnt) * {bins}) div n > ((n - cum_cnt) * {bins}) div n AND cum_cnt > cnt")
        for r in running.where(passes).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("v")).collect():
            edges[r["column"]] = list(r["v"])
    if present:
        cast = train.select(*[values[c].alias(c) for c in present])
        long = cast.unpivot([], present, "column", "value").where("value IS NOT NULL").distinct()
        # One more than allowed is enough to tell that there are too many.
        ranked = long.withColumn("_i", F.row_number().over(Window.partitionBy("column").orderBy("value"))).where(F.col("_i") <= MOST_CATEGORIES + 1)
        for r in ranked.groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("v")).collect():
            if len(r["v"]) > MOST_CATEGORIES:
                raise ValueError(f"{r['column']} has over {MOST_CATEGORIES} values, too many for a category")
            edges[r["column"]] = list(r["v"])
    known = tuple(tuple(edges.get(c, ())) for c in features)
    return Bins(tuple(features), frozenset(i for i, c in enumerate(features) if c in categories), known)


def level_sums(rows: DataFrame, node: Column, nodes: list[int]) -> DataFrame:
    """(node, feature, bin, g, h, n) of the ``nodes``: at most nodes x features x bins rows."""
    placed = rows.select(node.alias("node"), "g", "h", "_bins").where(F.col("node").isin(nodes))
    long = placed.select("node", "g", "h", F.posexplode("_bins").alias("feature", "bin"))
    return long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))


def with_siblings(sums: pd.DataFrame, nodes: list[int], parents: pd.DataFrame) -> pd.DataFrame:
    """The sums of ``nodes`` and those of their siblings, which have what is left of their ``parents``' sums.

    All are integers, so what is left is what a sum over the sibling's rows would give.
    """
    sibling = {n // 2: n ^ 1 for n in nodes}
    own = parents[parents["node"].isin(list(sibling))]
    taken = sums.assign(node=sums["node"] ^ 1, g=-sums["g"], h=-sums["h"], n=-sums["n"])
    rest = pd.concat([own.assign(node=own["node"].map(sibling)), taken]).groupby(["node", "feature", "bin"], as_index=False)[["g", "h", "n"]].sum()
    return pd.concat([sums, rest[rest["n"] > 0]], ignore_index=True)


def best_splits(sums: pd.DataFrame, categories: frozenset[int], params: Boosting) -> dict[int, Split]:
    """The split of most gain of each node that has one; ties go to the first feature, then bin, then the right side."""
    found: dict[int, Split] = {}
    for (node, feature), own in sums.groupby(["node", "feature"], sort=True):
        absent = (own["bin"] == MISSING).to_numpy()
        bins = own["bin"].to_numpy()[~absent]
        parts = own[["g", "h", "n"]].to_numpy(np.int64)
        known, none, total = parts[~absent], parts[absent].sum(axis=0), parts.sum(axis=0)
        place = known[:, 0] / UNIT / (known[:, 1] / UNIT + params.l2) if feature in categories else bins
        order = np.lexsort((bins, place))
        upto = np.cumsum(known[order], axis=0)
        left = np.stack([upto, upto + none], axis=1).reshape(-1, 3)  # per cut: missing right, missing left
        right = total - left
        (lg, lh), (rg, rh) = ((side[:, 0] / UNIT, side[:, 1] / UNIT + params.l2) for side in (left, right))
        g, h = total[0] / UNIT, total[1] / UNIT + params.l2
        gain = np.where(np.minimum(left[:, 2], right[:, 2]) >= params.min_rows, lg * lg / lh + rg * rg / rh - g * g / h, 0.0)
        at = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[at] > max(LEAST_GAIN, found[node].gain if node in found else 0.0):
            values = (float(-params.step * lg[at] / lh[at]), float(-params.step * rg[at] / rh[at]))
            prefix = tuple(int(b) for b in bins[order][: at // 2 + 1])
            found[int(node)] = Split(int(feature), prefix, bool(at % 2), float(gain[at]), int(left[at, 2]), int(right[at, 2]), *values)
    return found


def _goes_left(split: Split, categories: frozenset[int]) -> Column:
    bin_ = F.get("_bins", F.lit(split.feature))
    known = bin_.isin(*split.left) if split.feature in categories else bin_.between(0, max(split.left))
    return (known | (bin_ == MISSING)) if split.missing_left else known


def _walk(tree: dict[int, Split], categories: frozenset[int], leaf, node: int = 1) -> Column:
    if node not in tree:
        return leaf(node)
    left, right = (_walk(tree, categories, leaf, child) for child in (2 * node, 2 * node + 1))
    return F.when(_goes_left(tree[node], categories), left).otherwise(right)


def leaf_values(tree: dict[int, Split]) -> dict[int, float]:
    values = {}
    for node, split in tree.items():
        values |= {2 * node: split.left_value, 2 * node + 1: split.right_value}
    return {n: v for n, v in values.items() if n not in tree}


def grow_tree(rows: DataFrame, bins: Bins, params: Boosting) -> dict[int, Split]:
    """A tree for rows with ``_bins`` and the integer gradients ``g`` and ``h``; empty if nothing gains.

    Below the root only the smaller child of a split is summed: half of the rows at most are
    spread over their features.
    """
    tree: dict[int, Split] = {}
    sums, nodes = None, [1]
    for _ in range(params.depth):
        node = _walk(tree, bins.categories, lambda n: F.lit(n))
        own = level_sums(rows, node, nodes).toPandas()  # its size depends on the tree, not on the rows
        sums = own if sums is None else with_siblings(own, nodes, sums)
        found = best_splits(sums, bins.categories, params)
        nodes = [2 * n + (s.n_right < s.n_left) for n, s in found.items()]
        if not found:
            break
        tree |= found
    return tree


def with_gradients(rows: DataFrame, margin: Column, pos_weight: float) -> DataFrame:
    """First and second derivative of the weighted log loss at the margin, in integers of ``1 / UNIT``."""
    p = 1.0 / (1.0 + F.exp(-margin))
    weight = F.when(F.col("_y") == 1, F.lit(float(pos_weight))).otherwise(F.lit(1.0))
    return rows.withColumn("_p", p).withColumns(
        {
            "g": F.floor((F.col("_p") - F.col("_y")) * weight * float(UNIT) + 0.5),
            "h": F.floor(F.col("_p") * (1.0 - F.col("_p")) * weight * float(UNIT) + 0.5),
        }
    )


def fit_boosted(
    rows: DataFrame,
    params: Boosting = Boosting(),
    features: list[str] | None = None,
    categories: list[str] | None = None,
    scale_pos_weight: float | None = None,
) -> BoostedModel:
    """Trees of the train split, cut back to the best average precision on the val split.

    ``rows`` has the features, ``is_churn`` and ``split``. NULL and NaN are missing values;
    values of a category that the train split lacks count as missing too. Without a val
    split, or with one class in it, all rounds stay. An empty train split gives no trees.
    """
    features = list(FEATURES if features is None else features)
    categories = list(CATEGORICAL_FEATURES if categories is None else categories)
    require_columns(rows, features + ["is_churn", "split"], "rows")
    train = rows.where("split = 'train'")
    if scale_pos_weight is None:
        scale_pos_weight = float(class_ratio(train).first()["scale_pos_weight"] or 1.0)
    model = BoostedModel(find_bins(train, features, categories, params.bins))
    start = stage(_binned(train, model.bins, F.col("is_churn").cast("int").alias("_y"), F.lit(0.0).alias("_margin")), "boost-rows")
    margin = F.col("_margin")
    for done in range(1, params.rounds + 1):
        tree = grow_tree(with_gradients(start, margin, scale_pos_weight), model.bins, params)
        if not tree:
            break
        model.trees.append(tree)
        values = leaf_values(tree)
        margin = margin + _walk(tree, model.bins.categories, lambda n: F.lit(values[n]))
        if done % STAGED_EVERY == 0 and done < params.rounds:
            start = stage(start.select("_bins", "_y", margin.alias("_margin")), "boost-rows")
            margin = F.col("_margin")
    val = rows.where("split = 'val'")
    if len(model.trees) > 1 and not val.isEmpty():
        curve = average_precision_by(margins_after_rounds(val, model), ["round"]).orderBy("round").collect()
        if all(r.auc_pr is not None for r in curve):
            model.trees = model.trees[: best_prefix([-r.auc_pr for r in curve], params.patience)]
    return model


def _binned(rows: DataFrame, bins: Bins, *others: Column) -> DataFrame:
    return rows.select(F.array(*[bins.column(i) for i in range(len(bins.features))]).alias("_bins"), *others)


def _margins(model: BoostedModel) -> np.ndarray:
    """Per tree, node and bin + 1: the next node; and per tree and node the leaf's value."""
    size = 2 << max((max(t) for t in model.trees), default=0).bit_length()
    width = max([len(e) for e in model.bins.edges] + [0]) + 2
    feature = np.zeros((len(model.trees), size), np.int32)
    step = np.repeat(np.arange(size)[None, :, None], width, 2).repeat(len(model.trees), 0).astype(np.int32)
    value = np.zeros((len(model.trees), size))
    for t, tree in enumerate(model.trees):
        for node, split in tree.items():
            feature[t, node] = split.feature
            left = np.zeros(width, bool)
            if split.feature in model.bins.categories:
                left[np.array(split.left) + 1] = True
            else:
                left[1 : max(split.left) + 2] = True
            left[0] = split.missing_left
            step[t, node] = np.where(left, 2 * node, 2 * node + 1)
        for node, v in leaf_values(tree).items():
            value[t, node] = v
    return feature, step, value


def _rounds_udf(model: BoostedModel):
    """Margins after every tree, from a row's bins. The tables are a few kB a tree."""
    feature, step, value = _margins(model)
    depth = int(feature.shape[1]).bit_length()

    @F.pandas_udf("array<double>")
    def margins(bins: pd.Series) -> pd.Series:
        if bins.empty or not len(feature):
            return pd.Series([np.zeros(0)] * len(bins), index=bins.index)
        at = np.stack(bins.to_numpy()).astype(np.int64)
        rows, out = np.arange(len(at)), np.zeros((len(at), len(feature)))
        for t in range(len(feature)):
            node = np.ones(len(at), np.int64)
            for _ in range(depth):  # a leaf leads to itself
                node = step[t, node, at[rows, feature[t, node]] + 1]
            out[:, t] = value[t, node]
        return pd.Series(list(np.cumsum(out, axis=1)), index=bins.index)

    return margins


def margins_after_rounds(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """(round, score, is_churn): each row's margin after every number of trees, counted from 1."""
    after = _binned(rows, model.bins, F.col("is_churn")).select("is_churn", _rounds_udf(model)("_bins").alias("_m"))
    return after.select(F.posexplode("_m").alias("_i", "score"), "is_churn").select((F.col("_i") + 1).alias("round"), "score", "is_churn")


def score_boosted(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """Add ``score``, the probability of churn; 0.5 for all rows if the model has no tree."""
    bins = F.array(*[model.bins.column(i) for i in range(len(model.bins.features))])
    margin = F.coalesce(F.element_at(F.when(F.size("_m") > 0, F.col("_m")), -1), F.lit(0.0)) if model.trees else F.lit(0.0)
    with_margin = rows.withColumn("_m", _rounds_udf(model)(bins)) if model.trees else rows
    return with_margin.select(*[f"`{c}`" for c in rows.columns], in_unit_interval(1.0 / (1.0 + F.exp(-margin))).alias("score"))


def splits_table(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """The model as rows, one per split: a numeric feature's ``cut`` (left is up to it) or a category's ``left_values``."""
    out = []
    for t, tree in enumerate(model.trees):
        for node, s in sorted(tree.items()):
            edges, of_category = model.bins.edges[s.feature], s.feature in model.bins.categories
            top = None if of_category or max(s.left) >= len(edges) else edges[max(s.left)]
            values = sorted(edges[b] for b in s.left) if of_category else None
            out.append((t + 1, node, model.bins.features[s.feature], top, values, s.missing_left, s.gain, s.n_left, s.n_right, s.left_value, s.right_value))
    schema = (
        "tree int, node int, feature string, cut double, left_values array<double>, missing_left boolean, gain double,"
        " n_left bigint, n_right bigint, left_value double, right_value double"
    )
    return rows.sparkSession.createDataFrame(out, schema)


def gain_shares(rows: DataFrame, model: BoostedModel) -> DataFrame:
    """(feature, importance): the features' shares of all gain, largest first; zeros if nothing was split."""
    gains = dict.fromkeys(model.bins.features, 0.0)
    for tree in model.trees:
        for split in tree.values():
            gains[model.bins.features[split.feature]] += split.gain
    total = sum(gains.values()) or 1.0
    shares = [(name, gain / total) for name, gain in sorted(gains.items())]
    return rows.sparkSession.createDataFrame(shares, "feature string, importance double").orderBy(F.desc("importance"), "feature")
