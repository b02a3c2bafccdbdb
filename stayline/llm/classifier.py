"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a few numbers that describe its form. Each number is cut into bins, and
the model is one lookup table per feature, plus one per chosen pair of features. Tables are
learnt by cyclic boosting: round after round, each feature in turn gets a shallow tree on
its own bins, fitted to the gradient that all tables so far leave; then the best pairs get
theirs. A score is a sum of table cells through the logistic function.

The fit uses a bounded sample of labelled rows (``Fit.rows``, chosen by a hash of the id, so
the same rows at any parallelism); everything else covers all rows. Labels that are null or
not 0 or 1 are left out; of several labels for an id the larger counts. Without both
classes the model is a constant. Null and empty texts are scored as empty texts. Repeated
rows each get their row. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.batches import Words, documents, small
from stayline.llm.columns import any_columns

FEATURES = (
    "log_words", "mean_length", "length_spread", "symbols_per_word", "marks_per_word", "bars_per_word", "points_per_word",
    "upper_share", "digit_share", "other_share", "distinct_share", "top_word_share", "echo_share", "repeat_share",
    "equal_line_share", "words_per_line",
)


def features(words: Words) -> np.ndarray:
    """A row for each text, a column for each of ``FEATURES``; all from the text's form, none from its language."""
    n = words.counts.astype(float)
    safe = np.maximum(n, 1)
    chars = words.summed(words.lengths)
    mean = chars / safe
    spread = np.sqrt(np.maximum(words.summed(words.lengths**2) / safe - mean**2, 0))
    data = words.bytes

    def share(members: bytes, of: np.ndarray) -> np.ndarray:
        mask = np.zeros(256, bool)
        mask[list(members)] = True
        return words.per_text(mask[data]) / of

    upper_ascii = (data >= 65) & (data <= 90)
    # Upper-case letters of the Latin-1 block: lead byte C3, then 80 to 9E but for the multiplication sign.
    upper_latin = np.zeros(len(data), bool)
    upper_latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    size = np.maximum(chars, 1)
    ids, text = words.ids, words.text_of
    echo = np.zeros(len(ids), bool)
    echo[1:] = (ids[1:] == ids[:-1]) & (text[1:] == text[:-1])
    distinct, top = np.zeros(words.n), np.zeros(words.n)
    if len(ids):
        keys, counts = np.unique(text * (ids.max() + 1) + ids, return_counts=True)
        owner = keys // (ids.max() + 1)
        distinct = np.bincount(owner, minlength=words.n).astype(float)
        np.maximum.at(top, owner, counts)
    lines, equal, _ = words.lines
    other = (data < 0x20) & (data != 10) | (data >= 0xF0)
    return np.column_stack(
        (
            np.log1p(n), mean, spread, share(b"#*$%&<>", safe), share(b"!?", safe), share(b"|", safe), share(b".,;:", safe),
            words.per_text(upper_ascii | upper_latin) / size, share(b"0123456789", size), words.per_text(other) / size,
            distinct / safe, top / safe, words.summed(echo) / safe, words.summed(words.repeated(3)) / safe,
            equal / np.maximum(lines, 1), n / np.maximum(lines, 1),
        )
    )


@dataclass(frozen=True)
class Fit:
    """``rows``: the most labelled rows that the fit reads. The rest shapes the model."""

    rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 120
    pairs: int = 6
    pair_rounds: int = 40
    rate: float = 0.15
    leaves: int = 4
    least_leaf: int = 3  # rare kinds of bad text are few rows of a small sample
    ridge: float = 2.0


@dataclass
class Model:
    """Intercept, edges and tables; a few kB, whatever the corpus."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-total))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Edges between bins of about equal size, midway between neighbouring values."""
    values = np.unique(x)
    if len(values) < 2:
        return np.zeros(0)
    wanted = np.quantile(x, np.arange(1, bins) / bins, method="higher")
    at = np.unique(np.searchsorted(values, wanted))
    at = np.unique(np.concatenate((at[at > 0], [1])))  # the smallest value, often 0, stands alone
    return (values[at - 1] + values[at]) / 2


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Fit) -> np.ndarray:
    """A tree of at most ``leaves`` leaves on ordered bins: the step for each bin."""
    leaves = [(0, len(g))]

    def gain(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, -1
        G, H, N = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
        left, rest = slice(0, b - a - 1), b - a - 1
        value = G[left] ** 2 / (H[left] + p.ridge) + (G[rest] - G[left]) ** 2 / (H[rest] - H[left] + p.ridge)
        value = value - G[rest] ** 2 / (H[rest] + p.ridge)
        value[(N[left] < p.least_leaf) | (N[rest] - N[left] < p.least_leaf)] = 0
        k = int(np.argmax(value))
        return float(value[k]), a + k + 1

    while len(leaves) < p.leaves:
        best = max(((*gain(a, b), (a, b)) for a, b in leaves), key=lambda t: t[0])
        if best[0] <= 1e-9:
            break
        leaves.remove(best[2])
        leaves += [(best[2][0], best[1]), (best[1], best[2][1])]
    step = np.zeros(len(g))
    for a, b in leaves:
        step[a:b] = -g[a:b].sum() / (h[a:b].sum() + p.ridge)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: Fit) -> tuple[np.ndarray, float]:
    """The best cross of one cut on each feature: four quadrants' steps, and the gain."""
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (g, h, n)]
    if g.shape[0] < 2 or g.shape[1] < 2:
        return np.zeros_like(g), 0.0

    def quadrants(s):
        a = s[:-1, :-1]
        return a, s[:-1, -1:] - a, s[-1:, :-1] - a, s[-1, -1] - s[:-1, -1:] - s[-1:, :-1] + a

    G, H, N = map(quadrants, sums)
    value = sum(x**2 / (y + p.ridge) for x, y in zip(G, H))
    value = np.where(np.minimum.reduce(N) >= p.least_leaf, value, -np.inf)
    i, j = np.unravel_index(int(np.argmax(value)), value.shape)
    if not np.isfinite(value[i, j]):
        return np.zeros_like(g), 0.0
    step = np.zeros_like(g)
    for x, y, rows, cols in zip(
        G, H, (slice(0, i + 1),) * 2 + (slice(i + 1, None),) * 2, (slice(0, j + 1), slice(j + 1, None)) * 2
    ):
        step[rows, cols] = -x[i, j] / (y[i, j] + p.ridge)
    return step, float(value[i, j])


def fit_model(x: np.ndarray, y: np.ndarray, p: Fit = Fit()) -> Model:
    if len(y) == 0 or y.min() == y.max():
        return Model(8.0 if len(y) and y[0] else (-8.0 if len(y) else 0.0))
    rate = y.mean()
    model = Model(float(np.log(rate / (1 - rate))))
    model.edges = [_cuts(x[:, j], p.bins) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes():
        s = 1 / (1 + np.exp(-total))
        return s - y, np.maximum(s * (1 - s), 1e-6)

    counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    for _ in range(p.rounds):
        for b, table, n in zip(bins, model.tables, counts):
            g, h = slopes()
            step = p.rate * _tree(np.bincount(b, g, len(table)), np.bincount(b, h, len(table)), n, p)
            table += step
            total += step[b]

    model.pair_edges = [_cuts(x[:, j], p.pair_bins) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    width = [len(e) + 1 for e in model.pair_edges]

    def grid(a: int, b: int, *weights):
        flat = coarse[a] * width[b] + coarse[b]
        return [np.bincount(flat, w, width[a] * width[b]).reshape(width[a], width[b]) for w in weights]

    g, h = slopes()
    every = [(a, b) for a in range(x.shape[1]) for b in range(a + 1, x.shape[1])]
    gains = [_pair_tree(*grid(a, b, g, h, np.ones(len(y))), p)[1] for a, b in every]
    model.pairs = [every[k] for k in sorted(np.argsort(gains, kind="stable")[::-1][: p.pairs]) if gains[k] > 0]
    model.pair_tables = [np.zeros((width[a], width[b])) for a, b in model.pairs]
    for _ in range(p.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = p.rate * _pair_tree(*grid(a, b, g, h, np.ones(len(y))), p)[0]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, p: Fit = Fit()) -> Model:
    """Fit on labelled rows that are not held out."""
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.rows)
    )
    ids = {r.doc_id: r.y for r in sample.collect()}  # at most p.rows
    if not ids:
        return fit_model(np.zeros((0, len(FEATURES))), np.zeros(0), p)
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = features(Words(batch.column("text").to_pylist()))
            y = pa.array([shared.value[d] for d in batch.column("doc_id").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), y, pa.array(x.tolist(), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    picked = documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    # One row an id, so that repeated rows do not grow what the driver reads.
    rows = picked.mapInArrow(run, "doc_id bigint, y double, x array<double>").groupBy("doc_id").agg(F.max(F.struct("y", "x")).alias("r"))
    got = sorted(rows.collect(), key=lambda r: r.doc_id)
    return fit_model(np.array([r.r.x for r in got]).reshape(-1, len(FEATURES)), np.array([r.r.y for r in got]), p)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            s = shared.value.score(features(Words(batch.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    scored = documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@any_columns
def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(shared.value.score(features(Words(texts))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
