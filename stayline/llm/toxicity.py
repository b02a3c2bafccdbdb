"""Toxicity by class-conditional Kneser-Ney models of words and word pairs.

Words are lower-cased runs of letters, digits and non-ASCII characters. Two models are
counted, of the toxic and of the ordinary labelled rows:

* a word's chance in a class is its discounted count in the class, plus the class's
  discounted mass times a backoff chance that both classes share: the word's share of the
  distinct (context, word) pairs of all labelled rows, a context being the word before or a
  text's begin. All pairs of both classes are counted for it, those seen once too;
* a word after another has its discounted pair count, plus the pair model's rest times the
  word's chance.

Expressions whose document counts show no difference between the classes (a likelihood-ratio
statistic below ``Fit.evidence``), rare ones above all, keep only what the classes share, so
they add nothing; pairs enter if the rows of a class hold them ``Fit.least_pair`` times. With
``Fit.contexts`` off, texts stand in for contexts, and only pairs of toxic rows are counted. A text's score
compares its two log-likelihoods, divided by a power of its length, through a logistic curve.

All labelled rows that are neither held out nor in the calibration fold are counted, at any
size, in shuffled tables; expressions are named by 64-bit hashes. Documents meet the table by
the keys of their chunks (``lookup``). Only filters of ``FILTER_BITS`` are broadcast: they
spare most keys the shuffle and change no result. The curve (three numbers) is fitted to a
sample of at most ``Fit.rows`` labelled rows of the calibration fold, taken by a hash of the id.

Null and empty texts have no words and so the score of an empty text. A null id is scored and
is not held out. Labels that are null or not 0 or 1, or have no id, are left out; of several
labels of an id the larger counts; repeated rows of a labelled id count each. Without both
classes every text has the same score. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.batches import documents, small
from stayline.llm.lookup import looked_up
from stayline.session import stage

FILTER_BITS = 1 << 25  # 4 MB, whatever the corpus
PROBES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # fixed odd numbers
SLICE = 4 << 20  # bytes of text counted at a time
PIECE = 1 << 15  # rows of counts handed on at a time
FOLDS, CALIBRATION = 5, 1  # fold 0 is held out
START = 0  # stands for the word before a text's first

_KEPT = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))


@dataclass(frozen=True)
class Fit:
    """``rows``: the most rows that the curve is fitted to; ``evidence``: 10.83 is met by chance once in a thousand.

    ``contexts``: back off by the distinct words before a word, counted over all pairs.
    """

    rows: int = 20_000
    discount: float = 0.75
    evidence: float = 10.83
    least_pair: int = 2
    powers: tuple[float, ...] = (0.25, 0.5, 0.75, 1.0)
    ridge: float = 1e-3
    contexts: bool = False


KNESER_NEY = Fit(contexts=True)


class Tokens:
    """The words of some texts, as hashes in text order."""

    def __init__(self, texts: list[str]):
        numbers: dict[bytes, int] = defaultdict(count().__next__)  # a word seen first gets the next number
        ids, self.counts = array("i"), np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):  # one text's words at a time; all others are only numbers
            words = text.lower().encode().translate(_KEPT).split()
            ids.extend(map(numbers.__getitem__, words))
            self.counts[i] = len(words)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
        self.keys = hashes[np.asarray(ids)].view(np.int64)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first word, and key, of every two neighbouring words of a text."""
        at = np.flatnonzero(self.text_of[1:] == self.text_of[:-1])
        return at, pair_key(self.keys[at], self.keys[at + 1])


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A key for two words in order, from their keys."""
    with np.errstate(over="ignore"):
        x = first.view(np.uint64) * np.uint64(PROBES[0]) + second.view(np.uint64) + np.uint64(1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(PROBES[1])
        return (x ^ (x >> np.uint64(29))).view(np.int64)


def _probes(keys: np.ndarray) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - (FILTER_BITS.bit_length() - 1))
    with np.errstate(over="ignore"):
        for p in PROBES:
            yield (((keys.view(np.uint64) ^ np.uint64(p >> 7)) * np.uint64(p)) >> shift).astype(np.int64)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that are surely not in the filter."""
    out = np.ones(len(keys), bool)
    for at in _probes(keys):
        out &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def key_filter(keys: DataFrame) -> Broadcast[np.ndarray]:
    """A filter of a fixed number of bits over the column ``key``; its words are or-ed by aggregates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate([*_probes(batch.column("key").to_numpy()), np.zeros(0, np.int64)]))
            words, first = np.unique(at >> 6, return_index=True)
            bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64))
            merged = np.bitwise_or.reduceat(bits, first) if len(first) else bits
            yield pa.RecordBatch.from_pydict({"word": words, "bits": merged.view(np.int64)})

    table = keys.select("key").mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bits)


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def labelled(labels: DataFrame) -> DataFrame:
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return usable.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _counted(keys: np.ndarray, *which: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, a place of each, and at how many of the places marked in each of ``which`` they stand."""
    distinct, first, number = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, first, [np.bincount(number[w], minlength=len(distinct)) for w in which]


def _by_document(keys: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """True at one place of each (text, key)."""
    order = np.lexsort((keys, text_of))
    k, t = keys[order], text_of[order]
    out = np.zeros(len(keys), bool)
    out[order[np.concatenate(([True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])))[: len(keys)]]] = True
    return out


SUMS = ("n_t", "n_o", "d_t", "d_o")
FOUND = "first bigint, second bigint, n_t bigint, n_o bigint, d_t bigint, d_o bigint, w_t bigint, w_o bigint"
COUNTS = "key bigint, first bigint, second bigint, n_t bigint, n_o bigint, d_t bigint, d_o bigint, contexts bigint"


def count_expressions(rows: DataFrame, p: Fit = Fit()) -> DataFrame:
    """Stored counts of the words and of the admitted pairs of ``rows`` (text, toxic).

    ``n_t`` and ``n_o`` are occurrences in toxic and ordinary rows, ``d_t`` and ``d_o`` rows;
    ``first`` and ``second`` are the words of a pair, null for a word. ``contexts`` is what a
    word's backoff share is counted in: the distinct words before it, a text's begin among
    them, or the rows without ``p.contexts``.
    """
    admitted = None if p.contexts else _toxic_pairs(rows, p)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, most=SLICE):
            tokens = Tokens(batch.column("text").to_pylist())
            is_toxic = batch.column("toxic").to_numpy() == 1
            new, (at, key) = _by_document(tokens.keys, tokens.text_of), tokens.pairs()
            if admitted is None:
                begin = np.flatnonzero(np.diff(tokens.text_of, prepend=-1))
                first, place = np.concatenate((tokens.keys[at], np.full(len(begin), START, np.int64))), np.concatenate((at + 1, begin))
                found = [(pair_key(first, tokens.keys[place]), first, place)]
            else:
                at, key = at[keep := passes(admitted.value, key)], key[keep]
                found = [(tokens.keys, None, np.arange(len(tokens.keys))), (key, tokens.keys[at], at + 1)]
            for keys, first, place in found:
                owner = tokens.text_of[place]
                t, once, w = is_toxic[owner], _by_document(keys, owner), new[place]
                distinct, one, sums = _counted(keys, t, ~t, t & once, ~t & once, t & w, ~t & w)
                second = tokens.keys[place[one]]
                words = [pa.nulls(len(distinct), pa.int64()) if first is None else pa.array(first[one]), pa.array(second)]
                out = pa.RecordBatch.from_arrays([*words, *map(pa.array, sums)], names=[x.split()[0] for x in FOUND.split(", ")])
                # Neighbours with the same counts and second word: the shuffle's codec then leaves out much of a row.
                order = None if first is None else np.lexsort((second, *sums))
                # Handed on in pieces, as the JVM holds a whole batch outside its heap.
                for start in range(0, len(distinct), PIECE):
                    yield out.slice(start, PIECE) if order is None else out.take(pa.array(order[start : start + PIECE]))

    found = rows.select("text", "toxic").mapInArrow(counts, FOUND).groupBy("first", "second")
    sums = found.agg(*[F.sum(c).alias(c) for c in ("n_t", "n_o", "w_t", "w_o", "d_t", "d_o")])
    if not p.contexts:
        kept = sums.where(F.col("first").isNull() | (F.col("n_t") >= p.least_pair)).select("first", "second", *SUMS, (F.col("d_t") + F.col("d_o")).alias("contexts"))
        return stage(kept.mapInArrow(_keyed, COUNTS), "expressions")
    # Each occurrence of a word ends one pair, the first one in a text too (``w_t`` and ``w_o``), so words are sums of
    # pairs. Both branches read all sums and filter no grouped column, so that they share one shuffle of the pairs.
    words = sums.groupBy("second").agg(
        F.sum("n_t").alias("n_t"), F.sum("n_o").alias("n_o"), F.sum("w_t").alias("d_t"), F.sum("w_o").alias("d_o"),
        F.count_if(F.col("d_t") + F.col("d_o") > 0).alias("contexts"),
    )
    most = F.greatest("n_t", "n_o") * (F.coalesce("first", F.lit(START)) != START).cast("bigint") + F.least(F.col("w_t") + F.col("w_o"), F.lit(0))
    pairs = sums.where(most >= p.least_pair).select("first", "second", *SUMS, F.lit(None).cast("bigint").alias("contexts"))
    kept = words.select(F.lit(None).cast("bigint").alias("first"), "second", *SUMS, "contexts").unionByName(pairs)
    return stage(kept.mapInArrow(_keyed, COUNTS), "expressions")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the keys of their words or pairs."""
    for batch in batches:
        first, second, *others = batch.columns
        word, second = first.is_null().to_numpy(zero_copy_only=False), second.to_numpy()
        key = np.where(word, second, pair_key(first.fill_null(START).to_numpy(), second))
        yield pa.RecordBatch.from_arrays([pa.array(key), first, pa.array(second, mask=word), *others], names=[x.split()[0] for x in COUNTS.split(", ")])


def _toxic_pairs(rows: DataFrame, p: Fit) -> Broadcast[np.ndarray]:
    """A filter of the pairs that toxic rows hold often enough."""

    def toxic_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, most=SLICE):
            _, key = Tokens(batch.column("text").to_pylist()).pairs()
            distinct, _, (n,) = _counted(key, np.ones(len(key), bool))
            yield pa.RecordBatch.from_pydict({"key": distinct, "n": n})

    toxic = rows.where("toxic = 1").select("text").mapInArrow(toxic_pairs, "key bigint, n bigint")
    return key_filter(toxic.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least_pair))


def _evidence(t: Column, o: Column, all_t: int, all_o: int) -> Column:
    """Likelihood-ratio statistic of a two by two table of documents."""
    n = float(all_t + all_o)

    def cell(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    t, o = t.cast("double"), o.cast("double")
    seen = t + o
    cells = [(t, seen * all_t / n), (o, seen * all_o / n), (all_t - t, (n - seen) * all_t / n), (all_o - o, (n - seen) * all_o / n)]
    return 2 * sum((cell(x, e) for x, e in cells[1:]), cell(*cells[0]))


def expression_values(counts: DataFrame, all_t: int, all_o: int, p: Fit = Fit()) -> DataFrame:
    """Stored (key, value): what one occurrence adds to the log-likelihood of the toxic model over the ordinary one.

    A pair's value comes on top of what its words add. ``all_t`` and ``all_o`` are the counted rows of each class.
    """
    words = counts.where("first IS NULL")
    total = words.agg(
        *[F.sum(c).alias(c) for c in ("n_t", "n_o")], F.sum("contexts").alias("held"),
        F.count_if(F.col("n_t") > 0).alias("kinds_t"), F.count_if(F.col("n_o") > 0).alias("kinds_o"),
    ).first()
    if not (total.n_t and total.n_o):
        return counts.select("key", F.lit(0.0).alias("value")).limit(0)
    shared = F.col("contexts") / F.lit(float(total.held))
    tells = (_evidence(F.col("d_t"), F.col("d_o"), all_t, all_o) >= p.evidence).alias("tells")

    def less(n: str) -> Column:
        return F.greatest(F.col(n) - p.discount, F.lit(0.0))

    def chance(n: str, everything: int, kinds: int) -> Column:
        return less(n) / float(everything) + F.least(F.lit(p.discount), F.lit(1.0)) * kinds / float(everything) * shared

    words = words.select("key", "n_t", "n_o", tells, shared.alias("shared"),
                         chance("n_t", total.n_t, total.kinds_t).alias("p_t"), chance("n_o", total.n_o, total.kinds_o).alias("p_o"))
    words = words.select("key", "n_t", "n_o", "tells", *[F.when(F.col("tells"), F.col(c)).otherwise(F.col("shared")).alias(c) for c in ("p_t", "p_o")])
    pairs = counts.where("first IS NOT NULL").where(tells)
    pairs = stage(pairs.select("key", "first", "second", less("n_t").alias("m_t"), less("n_o").alias("m_o")), "telling-pairs")
    # Only words that tell something or are in such a pair are needed any further.
    in_pairs = key_filter(pairs.select(F.explode(F.array("first", "second")).alias("key")))
    words = stage(only_known(words, in_pairs, "key", "tells"), "telling-words")
    # What a first word's pairs leave to the second word's own chance.
    led = pairs.groupBy(F.col("first").alias("key")).agg(F.sum("m_t").alias("led_t"), F.sum("m_o").alias("led_o"))

    def rest(led: str, n: str) -> Column:
        return F.coalesce(1 - F.try_divide(F.col(led), F.col(n).cast("double")), F.lit(1.0))

    words = words.join(led, "key", "left").select(
        "key", "n_t", "n_o", "tells", "p_t", "p_o", "led_t", rest("led_t", "n_t").alias("rest_t"), rest("led_o", "n_o").alias("rest_o")
    )
    alone = words.where("tells OR led_t IS NOT NULL").select(
        "key", (F.ln(F.col("p_t") / F.col("p_o")) + F.ln(F.col("rest_t") / F.col("rest_o"))).alias("value")
    )
    first = words.select(F.col("key").alias("first"), "n_t", "n_o", "rest_t", "rest_o")
    second = words.select(F.col("key").alias("second"), "p_t", "p_o")
    joined = pairs.join(first, "first").join(second, "second")

    def after(m: str, n: str, rest: str, own: str) -> Column:
        own = F.col(rest) * F.col(own)
        return F.ln((F.coalesce(F.try_divide(F.col(m), F.col(n).cast("double")), F.lit(0.0)) + own) / own)

    value = after("m_t", "n_t", "rest_t", "p_t") - after("m_o", "n_o", "rest_o", "p_o")
    return stage(alone.unionByName(joined.select("key", value.alias("value"))), "values")


def only_known(rows: DataFrame, known: Broadcast[np.ndarray], key: str, also: str | None = None) -> DataFrame:
    """The rows whose ``key`` passes the filter or whose column ``also`` is true: spares most others the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(known.value, batch.column(key).to_numpy())
            yield batch.filter(pa.array(keep if also is None else keep | batch.column(also).to_numpy(zero_copy_only=False)))

    return rows.mapInArrow(run, rows.schema)


@dataclass(frozen=True)
class Curve:
    """Score of a text: logistic(``slope`` * difference / words ** ``power`` + ``start``)."""

    power: float
    slope: float
    start: float

    def apply(self, difference: Column, words: Column) -> Column:
        x = F.lit(self.slope) * difference / F.pow(F.greatest(words, F.lit(1)).cast("double"), F.lit(self.power)) + F.lit(self.start)
        return 1 / (1 + F.exp(-x))


def fit_curve(words: np.ndarray, difference: np.ndarray, toxic: np.ndarray, p: Fit = Fit()) -> Curve:
    """The power of the length and the logistic curve with the largest likelihood."""
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return Curve(1.0, 0.0, 0.0 if len(toxic) == 0 else (5.0 if toxic[0] else -5.0))
    best = None
    for power in p.powers:
        x = difference / np.maximum(words, 1) ** power
        scale = max(float(np.abs(x).max()), 1e-12)
        x = np.column_stack((x / scale, np.ones(len(x))))
        w = np.array([0.0, np.log(toxic.mean() / (1 - toxic.mean()))])
        penalty = np.array([p.ridge, 0.0])
        for _ in range(60):
            s = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            step = np.linalg.solve((x * (s * (1 - s) + 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (s - toxic) + penalty * w)
            w = w - np.clip(step, -4, 4)
        s = np.clip(1 / (1 + np.exp(-np.clip(x @ w, -40, 40))), 1e-12, 1 - 1e-12)
        loss = -np.mean(toxic * np.log(s) + (1 - toxic) * np.log(1 - s))
        if best is None or loss < best[0] - 1e-12:
            best = (loss, Curve(power, float(w[0] / scale), float(w[1])))
    return best[1]


ROW = "chunk string, doc_id array<bigint>, n_words array<bigint>, keys array<bigint>, ends binary, place binary, times binary"


def text_terms(docs: DataFrame, known: Broadcast[np.ndarray]) -> DataFrame:
    """Chunk rows: the documents' words, and how often each holds which key that passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, batch in enumerate(small(batches, most=SLICE)):
            tokens = Tokens(batch.column("text").to_pylist())
            at, key = tokens.pairs()
            keys, owner = np.concatenate((tokens.keys, key)), np.concatenate((tokens.text_of, tokens.text_of[at]))
            keep = passes(known.value, keys)
            distinct, number = np.unique(keys[keep], return_inverse=True)
            width = max(1, len(distinct))
            code, times = np.unique(owner[keep] * width + number, return_counts=True)
            ends = np.cumsum(np.bincount(code // width, minlength=batch.num_rows))
            whole = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": [f"{part}-{n}"], "doc_id": pa.array([batch.column("doc_id").to_pylist()], whole),
                    "n_words": pa.array([tokens.counts], whole), "keys": pa.array([distinct], whole), "ends": [ends.astype(np.int64).tobytes()],
                    "place": [(code % width).astype(np.int32).tobytes()], "times": [times.astype(np.int32).tobytes()],
                }
            )

    return documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, ROW)


def differences(docs: DataFrame, values: DataFrame) -> DataFrame:
    """Stored (doc_id, n_words, difference) of every row: its log-likelihood in the toxic model less that in the ordinary one."""
    chunks = stage(text_terms(docs, key_filter(values)), "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                keys, found = row["keys"].values.to_numpy(zero_copy_only=False), row["found"].values
                value = np.zeros(len(keys))
                if found is not None and len(found):
                    value[np.searchsorted(keys, found.field("key").to_numpy())] = found.field("value").to_numpy()
                ends, place, times = (np.frombuffer(row[c].as_py(), t) for c, t in (("ends", np.int64), ("place", np.int32), ("times", np.int32)))
                doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                total = np.bincount(doc, value[place] * times, len(ends))
                yield pa.RecordBatch.from_arrays([row["doc_id"].values, row["n_words"].values, pa.array(total, pa.float64())], names=["doc_id", "n_words", "difference"])

    ready = looked_up(chunks, "keys", values, ["value"]).select("doc_id", "n_words", "keys", "ends", "place", "times", "found")
    return stage(ready.mapInArrow(run, "doc_id bigint, n_words bigint, difference double"), "differences")


def score_toxicity(docs: DataFrame, labels: DataFrame, p: Fit = KNESER_NEY, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learnt from the labelled rows of the other folds."""
    marked = stage(labelled(labels), "toxic-labels")
    learnt = marked.where(fold() > CALIBRATION)
    counted = documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).where(fold() > CALIBRATION)
    # A sort-merge join at every size, so that what is shuffled grows with the input.
    rows = only_known(counted, key_filter(learnt.withColumnRenamed("doc_id", "key")), "doc_id").hint("merge").join(learnt, "doc_id")
    rows = stage(rows.select("text", "toxic"), "labelled-texts")
    sizes = rows.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("o")).first()
    scored = differences(docs, expression_values(count_expressions(rows, p), sizes.t, sizes.o, p))
    sample = (
        marked.where(fold() == CALIBRATION)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(p.rows)
        .join(scored.groupBy("doc_id").agg(F.max(F.struct("n_words", "difference")).alias("r")), "doc_id")
        .select("doc_id", "toxic", "r.*")
    )
    got = sorted(sample.collect(), key=lambda r: r.doc_id)  # at most p.rows, one an id
    curve = fit_curve(np.array([r.n_words for r in got], float), np.array([r.difference for r in got]), np.array([r.toxic for r in got], float), p)
    score = curve.apply(F.col("difference"), F.col("n_words"))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), score.alias("score")).select(
        "*", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
