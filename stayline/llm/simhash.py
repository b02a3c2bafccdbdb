"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits. They are cut into segments of about 21 bits, so that two
fingerprints which differ in at most ``distance`` bits differ in at most
``distance // segments`` bits of some segment. On each segment the anchors are the words of
a covering code: a Hamming code on the first 15 bits (every word is within 1 of a code
word) and all words on the rest. A fingerprint goes to every anchor within the covering
radius plus the segment's threshold; of two that are close in a segment, the anchor nearest
to one is then within reach of the other, so they meet there. At each anchor the
fingerprints are compared over all 64 bits, and links within an anchor are reduced to one
link per fingerprint before they leave the task.

Equal fingerprints are one node, so exact copies cost nothing. An anchor with more than
``BLOCK`` fingerprints is split into blocks, and each pair of blocks is a group of its own:
no task holds more than two blocks, and no pair is lost.

Null and empty texts have the fingerprint zero, which links like any other. Repeated rows
each get their row. A null doc_id takes part, but is never a component's id unless all are
null. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from stayline.llm.batches import documents, small
from stayline.llm.columns import any_columns
from stayline.llm.components import components
from stayline.session import stage

SHINGLE, SEED, DISTANCE = 4, 42, 4
BLOCK = 4096
WIDE, SIMILAR, BANDS, ROWS, SETS = 5, 0.8, 20, 4, 512  # of keep_one_similar


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of the text's shingles."""
    words = text.encode().lower().split()  # for bytes, lower() changes A-Z only
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):
        part = hashes[a : a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, "doc_id bigint, fp bigint")


@dataclass(frozen=True)
class Covering:
    """Segments of the 64 bits, each with a Hamming code on its first ``2**parity - 1`` bits."""

    segments: int = 3
    parity: int = 4
    distance: int = DISTANCE

    @property
    def bounds(self) -> list[tuple[int, int]]:
        edges = [64 * k // self.segments for k in range(self.segments + 1)]
        return list(zip(edges, edges[1:]))

    @property
    def reach(self) -> int:
        return 1 + self.distance // self.segments  # covering radius 1, plus the segment's threshold


def _syndrome(words: np.ndarray, parity: int) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    for k in range(parity):
        mask = sum(1 << (i - 1) for i in range(1, 2**parity) if i >> k & 1)
        out |= (np.bitwise_count(words & np.uint64(mask)) & 1).astype(np.int64) << k
    return out


@lru_cache(maxsize=16)
def _flips(width: int, parity: int, reach: int) -> list[np.ndarray]:
    """By syndrome of a word: the changes of at most ``reach`` bits that turn it into an anchor."""
    changes = np.array([sum(1 << i for i in c) for k in range(reach + 1) for c in combinations(range(width), k)], np.uint64)
    syndromes = _syndrome(changes, parity)
    return [changes[syndromes == s] for s in range(2**parity)]


def anchors(prints: np.ndarray, code: Covering) -> tuple[np.ndarray, np.ndarray]:
    """(anchor key, fingerprint) for every fingerprint and anchor in reach."""
    keys, owners = [], []
    for number, (low, high) in enumerate(code.bounds):
        words = (prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        syndromes = _syndrome(words, code.parity)
        for s, change in enumerate(_flips(high - low, code.parity, code.reach)):
            at = np.flatnonzero(syndromes == s)
            if len(at):
                keys.append((words[at, None] ^ change).ravel() | np.uint64(number << 40))
                owners.append(np.repeat(prints[at], len(change)))
    return np.concatenate(keys), np.concatenate(owners)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable by the links a-b, for each of n rows."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for side in (a, b):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if np.array_equal(before, root):
            break
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _near(keys: np.ndarray, sides: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with equal keys whose fingerprints are close; rows are sorted by key.

    Within a split anchor, two different blocks are compared with each other only.
    """
    left, right = [], []
    at, lag = np.arange(len(keys)), 0
    while len(at) and lag < 256:
        lag += 1
        at = at[at + lag < len(keys)]
        at = at[keys[at] == keys[at + lag]]
        close = at[np.bitwise_count(prints[at] ^ prints[at + lag]) <= distance]
        left.append(close)
        right.append(close + lag)
    if len(at):  # groups with more rows than that: whole blocks at a time, beyond the lags above
        starts = np.unique(np.searchsorted(keys, keys[at]))
        for start in starts.tolist():
            stop = int(np.searchsorted(keys, keys[start], side="right"))
            for i in range(start, stop, 256):
                j = i + 256  # rows i+lag for lag > 256 start here
                if j >= stop:
                    break
                grid = np.bitwise_count(prints[i : min(i + 256, stop), None] ^ prints[None, j:stop]) <= distance
                x, y = np.nonzero(grid)
                left.append(x + i)
                right.append(y + j)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    return a, b


def _spread(placed: DataFrame, item: str, block: int) -> DataFrame:
    """(place, item): the anchors, those with more than ``block`` items split into pairs of blocks."""
    # Anchors to split; Spark broadcasts them only while they are below its size threshold.
    crowded = placed.groupBy("anchor").count().where(F.col("count") > block).select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(item), F.col("blocks")).cast("int")
    return (
        placed.join(crowded, "anchor", "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks") - 1, F.lit(0)))))
        .select(
            F.when(F.col("blocks").isNull(), F.col("anchor"))
            .otherwise(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")))
            .alias("place"),
            item,
        )
    )


def links(nodes: DataFrame, code: Covering = Covering(), block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that give the same components as all close pairs."""

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(prints), 4096):
                keys, owners = anchors(prints[i : i + 4096], code)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(owners.view(np.int64))], names=["anchor", "fp"])

    spread = _spread(nodes.select("fp").mapInArrow(replicate, "anchor bigint, fp bigint"), "fp", block)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64))

        def found(keys, prints):
            a, b = _near(keys, keys, prints, code.distance)
            root = local_roots(len(keys), a, b)
            at = np.flatnonzero(root != np.arange(len(keys)))
            pair = np.unique(np.column_stack((prints[at].view(np.int64), prints[root[at]].view(np.int64))), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

        parts: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            keys = batch.column("place").to_numpy(zero_copy_only=False)
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            parts.append((keys, prints))
            rows += len(keys)
            if rows < 1 << 17:
                continue
            keys, prints = (np.concatenate(x) for x in zip(held, *parts))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if cut:
                yield found(keys[:cut], prints[:cut])
            held, parts, rows = (keys[cut:], prints[cut:]), [], 0
        keys, prints = (np.concatenate(x) for x in zip(held, *parts))
        if len(keys):
            yield found(keys, prints)

    return (
        spread.repartition("place").sortWithinPartitions("place")
        .mapInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(docs: DataFrame, code: Covering = Covering(), block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    return _grouped(stage(fingerprints(docs), "fingerprints"), None, code, block)


def _grouped(rows: DataFrame, more: DataFrame | None, code: Covering, block: int) -> DataFrame:
    """(doc_id, fingerprint, component_id) of the fingerprinted rows; ``more`` holds further links."""
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = links(nodes, code, block)
    roots = components(found.union(more) if more is not None else found).select(F.col("node").alias("fp"), "root")
    linked = roots.join(nodes, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(smallest, "root").select("fp", "least")
    ids = nodes.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return rows.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@any_columns
def keep_one(docs: DataFrame, code: Covering = Covering()) -> DataFrame:
    """The documents, with all their columns, less those that a smaller id of their component stands for.

    Rows that repeat a doc_id count as one document, of which one row stays. A row without
    an id can't be stood for, and stays.
    """
    return _one_of_each(docs, near_duplicates(docs, code))


def _one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    chosen = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__chosen")).distinct()
    kept = docs.join(chosen.hint("merge"), docs["doc_id"] == chosen["__chosen"], "left_semi")
    once = Window.partitionBy("doc_id").orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    single = kept.withColumn("__copy", F.row_number().over(once)).where("__copy = 1").drop("__copy")
    return single.unionByName(docs.where("doc_id IS NULL"))


def shingle_set(text: str, width: int = WIDE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run, one without words none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n))


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(shingles: np.ndarray) -> list[int]:
    """A key for each band of MinHash values."""
    if not len(shingles):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(shingles), 1 << 12):
            x = shingles[a : a + (1 << 12)] * _factors()
            least = np.minimum(least, (x ^ (x >> np.uint64(31))).min(axis=1))
    return [xxhash.xxh64_intdigest(v.tobytes(), k) for k, v in enumerate(least.reshape(BANDS, ROWS))]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, key, bands) of every row; ``key`` is a digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column("text").to_pylist()
            prints = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            held = [np.array(bands(shingle_set(t)), np.uint64).view(np.int64) for t in texts]
            columns = [batch.column("doc_id"), pa.array(prints), batch.column("key"), pa.array(held, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "key", "bands"])

    rows = documents(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.unhex(F.sha2("text", 256)).alias("key"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint, key binary, bands array<bigint>")


def _joined(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Pairs of sets with a Jaccard similarity of ``least`` or more that connect all that such pairs connect."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    root, pairs = np.arange(len(sets)), []
    for i in range(1, len(sets)):
        low, high = np.minimum(sizes[:i], sizes[i]), np.maximum(sizes[:i], sizes[i])
        open_ = np.flatnonzero(low >= least * high)
        while len(open_):
            j, open_ = int(open_[0]), open_[1:]
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared >= least * (sizes[i] + sizes[j] - shared) - 1e-9:
                pairs.append((i, j))
                root[root == root[i]] = root[j]
                open_ = open_[root[open_] != root[i]]
    return pairs


def similar_links(docs: DataFrame, rows: DataFrame, least: float = SIMILAR, block: int = SETS) -> DataFrame:
    """Links (a, b) between fingerprints of texts whose exact shingle sets are similar, of texts that meet in some band."""
    placed = rows.where("size(bands) > 0").select("fp", "key", F.explode("bands").alias("anchor")).distinct()
    met = placed.groupBy("anchor").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high").select("anchor")
    owners = stage(placed.join(met, "anchor").select("anchor", F.struct("fp", "key").alias("item")), "band-owners")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], names=["key", "shingles"])

    wanted = owners.select(F.col("item.key").alias("key")).distinct()
    texts = documents(docs).select(F.unhex(F.sha2("text", 256)).alias("key"), "text").join(wanted, "key", "left_semi")
    once = texts.groupBy("key").agg(F.first("text").alias("text"))
    sets = stage(once.mapInArrow(hashed, "key binary, shingles binary"), "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, prints, held = None, [], []

        def found():
            pairs = _joined(held, least)
            a, b = ([prints[p[k]] for p in pairs] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for place, fp, raw in zip(*(batch.column(c).to_pylist() for c in ("place", "fp", "shingles"))):
                if place != now and held:
                    yield found()
                    prints, held = [], []
                now = place
                prints.append(fp)
                held.append(np.frombuffer(raw, np.uint64))
        if held:
            yield found()

    spread = _spread(owners, "item", block).select("place", F.col("item.fp").alias("fp"), F.col("item.key").alias("key")).distinct()
    return (
        spread.join(sets, "key").select("place", "fp", "shingles")
        .repartition("place").sortWithinPartitions("place")
        .mapInArrow(compare, "a bigint, b bigint")
        .where("a <> b")
        .distinct()
    )


@any_columns
def keep_one_similar(docs: DataFrame, code: Covering = Covering(), least: float = SIMILAR) -> DataFrame:
    """As :func:`keep_one`, with texts of 5-word Jaccard similarity ``least`` or more linked as well.

    ``BANDS`` keys of ``ROWS`` MinHash values each nominate pairs: one of similarity s is met
    with probability 1 - (1 - s**ROWS)**BANDS, over 0.9999 for 0.8. What they nominate is
    compared by exact sets of shingles. Bands with over ``SETS`` texts are split like anchors.
    """
    rows = stage(sketches(docs), "sketches")
    more = stage(similar_links(docs, rows, least), "similar")
    return _one_of_each(docs, _grouped(rows.select("doc_id", "fp"), more, code, BLOCK))
