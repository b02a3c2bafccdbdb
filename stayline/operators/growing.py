"""Spark ML's boosted classification trees, grown from blocks of packed bins.

The trees are those of ``GBTClassifier``: a first tree of the labels -1 and 1, then trees of
the log loss' residuals; splits by weighted variance; a share of the rows per tree and of the
features per node. What is read again for every level is smaller: bins of all train rows are
found once and kept as one byte for several features (a number's bin and its missing flag are
one code, and codes share a byte while their product fits), in blocks of rows of one label.
A level is one sum over (node, byte), from which each feature's sums follow; of two children
one is summed, the other has the rest. Only sums over nodes, features and bins reach the driver.

Residuals are summed as integers of ``1 / UNIT``, so a tree is the same for any order of
blocks and any retry of tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial
from itertools import groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, Row

from stayline.session import scratch_root, stage

BLOCK = (1 << 16) - 1  # rows; their counts and residuals fill 53 bits
UNIT = 1 << 19  # a residual is 4 at most, so a block's sum of them stays below one count
COUNT = 1 << 37  # a row adds this and its residual: both sums of a block are exact in one double
LARGEST = (1 << 21) - 1
LEFT_OUT = (1 << 32) - 1  # stands for the residual of a row that the tree does not see
CODES = 256
LEAST_GAIN = 1e-12
BLOCKS_A_TASK = 64
NODES_A_JOB = 256
HERE_ROWS = 1 << 20  # with margins and residuals about 22 MB
CHECKPOINT_EVERY = 10
MASKED_LEVELS = 3  # levels of few nodes are walked node by node, deeper ones row by row


@dataclass(frozen=True)
class Layout:
    """How the features of a vector lie in the bytes of a row.

    ``cuts`` of each number (left is up to the cut) and ``arity`` of each category. The vector
    has the numbers, where ``absent`` stands for NULL, then their missing flags, then the categories.
    """

    cuts: tuple[tuple[float, ...], ...]
    arity: tuple[int, ...]
    absent: float

    @cached_property
    def sizes(self) -> list[int]:
        """Codes of each field: a number's bins and one code for NULL, or a category's values."""
        return [len(c) + 2 for c in self.cuts] + list(self.arity)

    @cached_property
    def features(self) -> int:
        return 2 * len(self.cuts) + len(self.arity)

    @cached_property
    def packs(self) -> list[list[int]]:
        """Fields that share a byte: the largest first, each into the first byte that has room."""
        sizes, packs, used = self.sizes, [], []
        for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
            if sizes[f] > CODES:
                raise ValueError(f"{sizes[f]} bins of one feature, at most {CODES} are possible")
            at = next((i for i, n in enumerate(used) if n * sizes[f] <= CODES), len(packs))
            if at == len(packs):
                packs.append([])
                used.append(1)
            packs[at].append(f)
            used[at] *= sizes[f]
        return packs

    def field_of(self, feature: int) -> int:
        n = len(self.cuts)
        return feature % n if feature < 2 * n else feature - n

    @cached_property
    def feature_bins(self) -> tuple[np.ndarray, np.ndarray, int]:
        """(cell, place, bins): cells of all fields in a row are added at these places of (feature, bin)."""
        bins = max([2] + [s - 1 for s in self.sizes[: len(self.cuts)]] + list(self.arity))
        cell, place, first, n = [], [], 0, len(self.cuts)
        for f, size in enumerate(self.sizes):
            codes = np.arange(size)
            cell.append(first + codes)
            if f < n:
                null = codes == size - 1
                place.append(f * bins + np.where(null, np.searchsorted(self.cuts[f], self.absent), codes))
                cell.append(first + codes)
                place.append((n + f) * bins + null)
            else:
                place.append((n + f) * bins + codes)
            first += size
        return np.concatenate(cell), np.concatenate(place), bins

    def goes_left(self, feature: int, bins: np.ndarray) -> np.ndarray:
        """Of all 256 values of the feature's byte, those whose rows go left if ``bins`` of the feature do."""
        n, f, sizes = len(self.cuts), self.field_of(feature), self.sizes
        codes = np.arange(sizes[f])
        if f < n:
            null = codes == sizes[f] - 1
            bin_ = null.astype(int) if feature >= n else np.where(null, np.searchsorted(self.cuts[f], self.absent), codes)
        else:
            bin_ = codes
        left = np.isin(bin_, bins)
        pack = next(p for p in self.packs if f in p)
        shape = [sizes[g] for g in pack]
        place = np.arange(CODES)
        inside = place < math.prod(shape)
        return inside & left[np.unravel_index(np.where(inside, place, 0), shape)[pack.index(f)]]


@dataclass(frozen=True)
class Split:
    feature: int
    bins: tuple[int, ...]
    gain: float
    children: tuple[int, int]


@dataclass
class Tree:
    """``splits`` of the inner nodes, and per node the rows and residuals of both labels; 0 is the root.

    ``squares`` has per node the rows' squared residuals, in units of ``(16 / UNIT) ** 2``, by label.
    """

    splits: dict[int, Split] = field(default_factory=dict)
    totals: list[np.ndarray] = field(default_factory=list)
    squares: np.ndarray | None = None

    def levels(self) -> list[list[int]]:
        out, nodes = [], [0]
        while nodes := [n for n in nodes if n in self.splits]:
            out.append(nodes)
            nodes = [c for n in nodes for c in self.splits[n].children]
        return out


# ── blocks ───────────────────────────────────────────────────────────────────


def pack_rows(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of one label, from the numbers, the categories' indexes and the label, in this order."""
    n, sizes, packs = len(layout.cuts), layout.sizes, layout.packs
    held: dict[bool, list[np.ndarray]] = {False: [], True: []}
    task, made = TaskContext.get().partitionId(), 0

    def block(positive: bool, codes: np.ndarray) -> pa.RecordBatch:
        nonlocal made
        made += 1
        key = (task << 32) + made
        return pa.RecordBatch.from_pydict(
            {"key": pa.array([key], pa.int64()), "positive": [positive], "n": pa.array([codes.shape[1]], pa.int32()), "codes": [codes.tobytes()]}
        )

    for batch in batches:
        fields = []
        for f, size in enumerate(sizes):
            column = batch.column(f)
            if f < n:
                x = column.fill_null(layout.absent).to_numpy(zero_copy_only=False)
                if np.isnan(x).any():
                    raise ValueError("a feature is NaN; NULL is the missing value")
                code = np.searchsorted(layout.cuts[f], x)
                if column.null_count:
                    code[column.is_null().to_numpy(zero_copy_only=False)] = size - 1
            else:
                code = column.to_numpy(zero_copy_only=False).astype(np.int64)
            fields.append(code)
        label = batch.column(len(sizes))
        if label.null_count:
            raise ValueError("is_churn is NULL")
        label = label.to_numpy(zero_copy_only=False)
        if not np.isin(label, (0, 1)).all():
            raise ValueError("is_churn must be 0 or 1")
        codes = np.stack([np.ravel_multi_index([fields[f] for f in p], [sizes[f] for f in p]) for p in packs]).astype(np.uint8)
        for positive in (False, True):
            held[positive].append(codes[:, label == positive])
            if sum(c.shape[1] for c in held[positive]) >= BLOCK:
                whole = np.concatenate(held[positive], axis=1)
                while whole.shape[1] >= BLOCK:
                    yield block(positive, whole[:, :BLOCK])
                    whole = whole[:, BLOCK:]
                held[positive] = [whole]
    for positive in (False, True):
        if held[positive] and (whole := np.concatenate(held[positive], axis=1)).shape[1]:
            yield block(positive, whole)


def as_block(row: Row) -> tuple[int, bool, int, bytes]:
    return row.key, row.positive, row.n, bytes(row.codes)


Places = dict[int, tuple[int, int]]


def places(blocks: DataFrame) -> tuple[Places, int, int]:
    """Of each stored block the number of its joined block and its order, from its key; and the joined blocks and rows in all.

    Each task that packs rows leaves up to two short blocks; those of one label are joined up to a
    block's length. A number per 65,535 rows or short block comes to the driver.
    """
    found: Places = {}
    joined, held, last, rows = 0, 0, None, 0
    for i, (label, key, n) in enumerate(sorted((not r.positive, r.key, r.n) for r in blocks.select("key", "positive", "n").collect())):
        if label != last or held + n > BLOCK:
            joined, held, last = joined + 1, 0, label
        held, rows = held + n, rows + n
        found[key] = (joined - 1, i)
    return found, joined, rows


def joined_blocks(own: Iterable[tuple], place: Places) -> Iterator[tuple]:
    """Blocks in their order, with short ones joined. A block keeps the key of its first part."""
    for _, parts in groupby(sorted(own, key=lambda b: place[b[0]][1]), key=lambda b: place[b[0]][0]):
        key, positive, n, codes = next(parts)
        if more := list(parts):
            codes = np.concatenate([block_codes((key, positive, n, codes)), *map(block_codes, more)], axis=1).tobytes()
            n += sum(b[2] for b in more)
        yield key, positive, n, codes


def dealt(blocks: DataFrame, place: Places, joined: int) -> RDD:
    """The joined blocks, dealt evenly. A lost partition is read again in the same order."""
    # A task waits for its worker longer than it counts a few blocks: one wave of tasks, or whole waves of full ones.
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    tasks = min(joined, cores * -(-joined // (cores * BLOCKS_A_TASK)))
    rows = blocks.rdd.map(lambda r: (place[r.key][0], as_block(r)))
    return rows.partitionBy(tasks, lambda i: i % tasks).mapPartitions(lambda own: joined_blocks((b for _, b in own), place))


def first_margin(block: tuple) -> tuple:
    """(key, positive, margins, squares) before any tree."""
    return block[0], block[1], bytes(8 * block[2]), None


def distances(margin: tuple, *drawn) -> tuple:
    """(positive, residuals, squares) of a block, from its margins."""
    key, positive, values, squares = margin
    return positive, residuals(key, positive, np.frombuffer(values, np.float64), *drawn).tobytes(), squares


def residuals(key: int, positive: bool, margin: np.ndarray, round_: int, row_share: float, seed: int) -> np.ndarray:
    """The distance to the label in integers, for rows of one label; rows the tree does not see are ``LEFT_OUT``."""
    if round_ == 0:
        q = np.full(len(margin), UNIT, np.uint32)
    else:
        with np.errstate(over="ignore"):
            away = 4.0 / (1.0 + np.exp(margin * (2.0 if positive else -2.0)))
        q = np.minimum(np.floor(away * UNIT + 0.5), LARGEST).astype(np.uint32)
    if row_share < 1.0:
        q[np.random.default_rng((seed, round_, key)).random(len(q), np.float32) >= row_share] = LEFT_OUT
    return q


# ── a tree over a block ──────────────────────────────────────────────────────


class Walk:
    """Leads the rows of a block down a tree, from their bytes."""

    def __init__(self, tree: Tree, layout: Layout):
        packs, n = layout.packs, max(len(tree.totals), 1)
        self.levels = tree.levels()
        self.small = n <= CODES
        self.pack = np.zeros(n, np.intp)
        self.child = np.repeat(np.arange(n), CODES).reshape(n, CODES).astype(np.uint8 if self.small else np.uint32)
        for node, split in tree.splits.items():
            f = layout.field_of(split.feature)
            self.pack[node] = next(i for i, p in enumerate(packs) if f in p)
            left = layout.goes_left(split.feature, np.array(split.bins))
            self.child[node] = np.where(left, *split.children)
        self.row = np.arange(n, dtype=np.intp) * CODES

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        rows = codes.shape[1]
        node = np.zeros(rows, self.child.dtype)
        deep = self.levels
        if self.small:
            for level in self.levels[:MASKED_LEVELS]:
                for n in level:
                    child = np.frombuffer(codes[self.pack[n]].tobytes().translate(self.child[n].tobytes()), np.uint8)
                    node ^= (node ^ child) & -(node == n).view(np.uint8)
            deep = self.levels[MASKED_LEVELS:]
        if deep:
            flat, own, table = codes.reshape(-1), np.arange(rows), self.child.reshape(-1)
            first = self.pack * rows
            for _ in deep:
                at = first.take(node)
                at += own
                code = flat.take(at)
                at = self.row.take(node)
                at += code
                node = table.take(at)
        return node


def block_codes(block: tuple) -> np.ndarray:
    _, _, n, codes = block
    return np.frombuffer(codes, np.uint8).reshape(-1, n)


def sums_of_task(pairs: Iterator[tuple], walk: Walk, nodes: list[int], layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One array (label, rows or residuals, node, cell) of all blocks of a task, and the squares that came with them."""
    sizes, packs = layout.sizes, layout.packs
    slot = np.full(max(len(walk.pack), 1), -1, np.intp)
    slot[nodes] = np.arange(len(nodes)) * CODES
    wanted = slot >= 0
    whole = np.zeros((2, 2, len(packs), len(nodes) * CODES), np.int64)
    both = np.zeros((len(packs), len(nodes) * CODES))
    held, label, squares = 0, False, 0

    def settle() -> None:
        nonlocal held
        n = np.floor(both * (1.0 / COUNT))
        whole[int(label), 0] += n.astype(np.int64)
        whole[int(label), 1] += (both - n * COUNT).astype(np.int64)
        both[:] = 0.0
        held = 0

    for block, (positive, q, own_squares) in pairs:
        codes, q = block_codes(block), np.frombuffer(q, np.uint32)
        if own_squares is not None:
            squares = squares + own_squares
        node = walk.nodes(codes)
        rows = np.flatnonzero(wanted.take(node) & (q != LEFT_OUT) if len(walk.levels) else q != LEFT_OUT)
        if held and (positive != label or held + len(rows) > BLOCK):
            settle()
        label, held = positive, held + len(rows)
        value = q.take(rows).astype(np.float64)
        value += COUNT
        first = slot.take(node.take(rows)) if len(nodes) > 1 else 0
        for p in range(len(packs)):
            np.add.at(both[p], np.add(first, codes[p].take(rows), dtype=np.intp), value)
    if held:
        settle()
    cells = []
    order = {f: (p, i) for p, pack in enumerate(packs) for i, f in enumerate(pack)}
    for f in range(len(sizes)):
        p, i = order[f]
        shape = [sizes[g] for g in packs[p]]
        own = whole[:, :, p].reshape(2, 2, len(nodes), CODES)[..., : math.prod(shape)].reshape(2, 2, len(nodes), *shape)
        cells.append(own.sum(axis=tuple(3 + k for k in range(len(shape)) if k != i)))
    yield np.concatenate(cells, axis=3), squares


def moved(pair: tuple, walk: Walk, values: np.ndarray, round_: int, row_share: float, seed: int) -> tuple:
    """A block's margins after a tree, and the squared residuals of the tree's leaves by label."""
    block, (key, positive, margin, _) = pair
    margin = np.frombuffer(margin, np.float64)
    node = walk.nodes(block_codes(block))
    q = residuals(key, positive, margin, round_, row_share, seed)
    seen = q != LEFT_OUT
    coarse = ((q[seen] + np.uint32(8)) >> np.uint32(4)).astype(np.float64)  # 17 bits, so squares of a block are exact
    squares = np.zeros((2, len(values)), np.int64)
    squares[int(positive)] = np.bincount(node[seen], weights=coarse * coarse, minlength=len(values)).astype(np.int64)
    return key, positive, (margin + values.take(node)).tobytes(), squares


# ── growing ──────────────────────────────────────────────────────────────────


@dataclass(frozen=True)
class Growth:
    """Settings of the trees, as ``GBTClassifier`` names them."""

    rounds: int
    depth: int
    step: float
    min_rows: int
    row_share: float
    feature_share: float
    seed: int
    pos_weight: float

    def weighted(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, weight, weighted sum of residuals) from (label, rows or residuals, ...)."""
        n, q = parts[:, 0], parts[:, 1]
        return n[0] + n[1], n[0] + self.pos_weight * n[1], (self.pos_weight * q[1] - q[0]) / UNIT


def best_split(cells: np.ndarray, layout: Layout, params: Growth, features: np.ndarray) -> tuple[int, tuple[int, ...], float, np.ndarray] | None:
    """(feature, left bins, gain, left parts) of the most gain among ``features``; ties go to the first feature, then bin."""
    cell, place, bins = layout.feature_bins
    parts = np.zeros((layout.features * bins, 2, 2), np.int64)
    np.add.at(parts, place, np.moveaxis(cells[..., cell], -1, 0))
    parts = parts.reshape(layout.features, bins, 2, 2).transpose(2, 3, 0, 1)[:, :, features]
    n, w, s = params.weighted(parts)
    order = np.tile(np.arange(bins), (len(features), 1))
    for i, f in enumerate(features):
        if f >= 2 * len(layout.cuts):  # a category's values in the order of their means, those without rows last
            order[i] = np.argsort(np.where(n[i] > 0, s[i] / np.where(n[i] > 0, w[i], 1.0), np.inf), kind="stable")
    parts = np.take_along_axis(parts, np.broadcast_to(order, parts.shape), axis=3).cumsum(axis=3)
    total = parts[:, :, :1, -1:]
    left, right = parts[..., :-1], total - parts[..., :-1]
    (nl, wl, sl), (nr, wr, sr), (_, w, s) = (params.weighted(side) for side in (left, right, total))
    valid = (nl >= params.min_rows) & (nr >= params.min_rows)
    gain = np.where(valid, (sl * sl / np.where(valid, wl, 1.0) + sr * sr / np.where(valid, wr, 1.0) - s * s / w) / w, 0.0)
    i, at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[i, at] > LEAST_GAIN:
        return None
    return int(features[i]), tuple(int(b) for b in order[i, : at + 1]), float(gain[i, at]), left[:, :, i, at]


def grow(sums, layout: Layout, params: Growth, round_: int) -> Tree:
    """A tree from ``sums(tree, nodes)``, the cells of some nodes of the tree as it is."""
    tree = Tree()
    cells = dict(zip([0], sums(tree, [0])))
    first = layout.sizes[0]
    tree.totals.append(cells[0][..., :first].sum(axis=-1))
    share = math.ceil(params.feature_share * layout.features)
    for level in range(params.depth):
        found = []
        for node, own in sorted(cells.items()):
            rng = np.random.default_rng((params.seed, round_, node))
            features = np.sort(rng.choice(layout.features, share, replace=False))
            if best := best_split(own, layout, params, features):
                feature, bins, gain, left = best
                children = (len(tree.totals), len(tree.totals) + 1)
                tree.splits[node] = Split(feature, bins, gain, children)
                tree.totals += [left, tree.totals[node] - left]
                found.append(node)
        if not found or level + 1 == params.depth:
            break
        # A child of fewer rows than two leaves need is a leaf; of others' parents the smaller child is summed.
        rows = {c: int(tree.totals[c][:, 0].sum()) for n in found for c in tree.splits[n].children}
        open_ = {c for c, n in rows.items() if n >= 2 * params.min_rows}
        smaller = {n: min(tree.splits[n].children, key=rows.get) for n in found if open_ & set(tree.splits[n].children)}
        if not smaller:
            break
        summed = dict(zip(smaller.values(), sums(tree, list(smaller.values()))))
        rest = {next(c for c in tree.splits[n].children if c != s): cells[n] - summed[s] for n, s in smaller.items()}
        cells = {c: v for c, v in (summed | rest).items() if c in open_}
    return tree


def leaf_values(tree: Tree, params: Growth) -> np.ndarray:
    """The mean residual of each node's rows; rows end in leaves only."""
    _, w, s = params.weighted(np.stack(tree.totals, axis=-1))
    return np.where(w > 0, s / np.where(w > 0, w, 1.0), 0.0)


class Here:
    """Blocks and margins in the memory of one task."""

    def __init__(self, blocks: list[tuple], layout: Layout, params: Growth):
        self.blocks, self.layout, self.params = blocks, layout, params
        self.margins = [first_margin(b) for b in blocks]

    def begin(self, round_: int) -> None:
        self.drawn = (round_, self.params.row_share, self.params.seed)
        self.left = [distances(m, *self.drawn) for m in self.margins]

    def sums(self, walk: Walk, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return next(sums_of_task(zip(self.blocks, self.left), walk, nodes, self.layout))

    def move(self, walk: Walk, values: np.ndarray) -> None:
        self.margins = [moved(pair, walk, values, *self.drawn) for pair in zip(self.blocks, self.margins)]

    def squares(self) -> np.ndarray:
        return sum(m[3] for m in self.margins)


class Spread:
    """Blocks, margins and residuals as frames in Spark's storage; margins go to the checkpoint folder from time to time."""

    def __init__(self, blocks: DataFrame, place: Places, joined: int, layout: Layout, params: Growth):
        self.sc, self.layout, self.params = blocks.sparkSession.sparkContext, layout, params
        if not self.sc.getCheckpointDir():
            self.sc.setCheckpointDir(scratch_root(blocks.sparkSession))
        self.codes = self._kept(dealt(blocks, place, joined))
        self.margins, self.old, self.stored = self._kept(self.codes.map(first_margin)), [], None

    @staticmethod
    def _kept(rdd: RDD) -> RDD:
        # Elements are pickled singly, so that frames can be zipped as they are.
        return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)

    def begin(self, round_: int) -> None:
        self.drawn = (round_, self.params.row_share, self.params.seed)
        if round_ and round_ % CHECKPOINT_EVERY == 0:
            self.margins.checkpoint()
        self.left = self._kept(self.margins.map(lambda m, drawn=self.drawn: distances(m, *drawn)))
        self.pairs = self.codes.zip(self.left)
        self.tasks = self.pairs.getNumPartitions()

    def sums(self, walk: Walk, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = self.pairs.mapPartitions(partial(sums_of_task, walk=walk, nodes=nodes, layout=self.layout))
        return parts.treeReduce(_added) if self.tasks > BLOCKS_A_TASK else parts.reduce(_added)

    def move(self, walk: Walk, values: np.ndarray) -> None:
        # The sums of this round have stored its margins, so those before are no longer needed.
        self._drop(self.old)
        if self.margins.is_checkpointed:
            _forget(self.sc, self.stored)
            self.stored = self.margins.getCheckpointFile()
        self.old = [self.margins, self.left]
        args = (walk, values, *self.drawn)
        self.margins = self._kept(self.codes.zip(self.margins).map(lambda pair: moved(pair, *args)))

    def squares(self) -> np.ndarray:
        found = self.margins.map(lambda m: m[3]).reduce(add)
        self._drop([self.codes, self.margins, *self.old])
        _forget(self.sc, self.stored)
        return found

    @staticmethod
    def _drop(frames: list[RDD]) -> None:
        for rdd in frames:
            rdd.unpersist()


def boosted(store: Here | Spread, layout: Layout, params: Growth) -> tuple[list[Tree], list[float]]:
    """The trees and their weights. A tree's squares come with the first sums of the next one."""
    trees, weights = [], []
    for round_ in range(params.rounds):
        store.begin(round_)
        came: list = []

        def sums(tree: Tree, nodes: list[int]) -> list[np.ndarray]:
            out = []
            for i in range(0, len(nodes), NODES_A_JOB):
                whole, squares = store.sums(Walk(tree, layout), nodes[i : i + NODES_A_JOB])
                came.append(squares)
                out += list(np.moveaxis(whole, 2, 0))
            return out

        trees.append(grow(sums, layout, params, round_))
        weights.append(params.step if round_ else 1.0)
        if round_:
            trees[-2].squares = came[0]
        store.move(Walk(trees[-1], layout), weights[-1] * leaf_values(trees[-1], params))
    trees[-1].squares = store.squares()
    return trees, weights


def grown(blocks: DataFrame, layout: Layout, params: Growth) -> tuple[list[Tree], list[float]]:
    """Trees of the stored blocks: a few are one task's work, which saves a job a level; else each level is a job over all."""
    place, joined, rows = places(blocks)
    if not joined:
        raise ValueError("empty train split")
    if rows > HERE_ROWS:
        return boosted(Spread(blocks, place, joined, layout, params), layout, params)

    def whole(rows: Iterator) -> Iterator[tuple[list[Tree], list[float]]]:
        yield boosted(Here(list(joined_blocks(map(as_block, rows), place)), layout, params), layout, params)

    return blocks.rdd.coalesce(1).mapPartitions(whole).collect()[0]


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


def _forget(sc: SparkContext, path: str | None) -> None:
    if path:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


# ── Spark's model ────────────────────────────────────────────────────────────


def to_spark(trees: list[Tree], weights: list[float], layout: Layout, params: Growth, estimator: GBTClassifier) -> GBTClassificationModel:
    """The trees as a model that Spark ML scores, explains and stores like one it fitted."""
    sc = SparkContext.getOrCreate()
    ml, mllib, gateway = sc._jvm.org.apache.spark.ml, sc._jvm.org.apache.spark.mllib, sc._gateway
    # Each dot of a class name asks the JVM, so names are looked up once.
    parse, stats_of, leaf = mllib.linalg.Vectors.parse, mllib.tree.impurity.VarianceCalculator, ml.tree.LeafNode
    inner, at_most, one_of = ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    tree_model, n = ml.regression.DecisionTreeRegressionModel, len(layout.cuts)

    def doubles(values) -> object:
        return parse(f"[{','.join(repr(float(v)) for v in values)}]").toArray()

    def split_of(split: Split) -> object:
        if split.feature >= 2 * n:
            return one_of(split.feature, doubles(split.bins), layout.arity[split.feature - 2 * n])
        cuts = (0.5,) if split.feature >= n else layout.cuts[split.feature]
        return at_most(split.feature, float(cuts[max(split.bins)]))

    def whole(tree: Tree) -> object:
        values = leaf_values(tree, params)
        squares = tree.squares.astype(object)  # by label and node; inner nodes have their children's
        for node in sorted(tree.splits, reverse=True):
            for child in tree.splits[node].children:
                squares[:, node] += squares[:, child]

        def made(node: int) -> tuple[object, float | None]:
            rows, w, s = (float(x) for x in params.weighted(tree.totals[node]))
            square = (float(squares[0, node]) + params.pos_weight * float(squares[1, node])) * (16 / UNIT) ** 2
            value, impurity = float(values[node]), max(square / w - (s / w) ** 2, 0.0) if w else 0.0
            stats, split = stats_of(doubles((w, s, square)), int(rows)), tree.splits.get(node)
            if split is not None:
                (left, at_left), (right, at_right) = (made(c) for c in split.children)
                if at_left is None or at_left != at_right:  # equal leaves are one, as in Spark
                    return inner(value, impurity, split.gain, left, right, split_of(split), stats), None
            return leaf(value, impurity, stats), value

        return made(0)[0]

    all_trees, all_weights = gateway.new_array(tree_model, len(trees)), gateway.new_array(sc._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        all_trees[i], all_weights[i] = tree_model(whole(tree), layout.features), weight
    estimator._transfer_params_to_java()
    java = estimator._java_obj
    model = ml.classification.GBTClassificationModel(java.uid(), all_trees, all_weights, layout.features, 2)
    return GBTClassificationModel(java.copyValues(model, ml.param.ParamMap()) and model)


def fit_trees(rows: DataFrame, layout: Layout, params: Growth, estimator: GBTClassifier) -> GBTClassificationModel:
    """Boosted trees of rows with the numbers (NULL if absent), the categories' indexes and the label, in this order."""
    packed = rows.mapInArrow(partial(pack_rows, layout=layout), "key bigint, positive boolean, n int, codes binary")
    trees, weights = grown(stage(packed, "tree-blocks"), layout, params)
    return to_spark(trees, weights, layout, params, estimator)
