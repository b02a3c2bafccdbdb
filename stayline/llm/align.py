"""Alignment of two tokenizers, cut at whitespace-token anchors.

Every text is tokenised whole by both. The byte offsets at which tokens of both end are
shared ends. A shared end after which both next tokens are space-marked (their bytes begin
with a space) is an anchor; anchors cut a document into windows of token ids, about one a
word. What a window aligns to depends on its ids alone, so it is worked out once per pair of
id tuples and looked up after that.

Tokens between two neighbouring shared ends are a group; each A token of a group is linked
to each of its B tokens. How many documents link a pair of ids is counted over the corpus:
documents are packed into chunk rows with the chunk's distinct pairs, the pairs are counted
by joins and aggregates, and each chunk gets the counts of its own pairs back.

Null and empty texts have no tokens, nor have texts whose joined token bytes differ from a
space and the text. Repeated rows are documents of their own and each count. A null id stays
null. Very long texts are tokenised whole, by one task. Columns besides ``doc_id`` and
``text`` are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from stayline.llm.batches import _mix, documents, small
from stayline.llm.lookup import looked_up
from stayline.session import stage

CHUNK = 2 << 20  # characters of text in a chunk row, if it holds more than one text
SLICE = 1 << 20  # bytes of text aligned at a time
LONG = 4096  # links of a group that are not listed one by one
REMEMBERED = 200_000  # windows that a task keeps before it begins its memory anew
# Beyond these characters the two implementations of A could know different Unicode versions.
UNSURE = re.compile("[^\x00-ɏ]")


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """A: byte-level merges from a JSON description. B: pieces with byte fallback, from a model file."""

    def __init__(self, spec: bytes, model: bytes, pattern: str):
        data = json.loads(spec)
        self._slow = Tokenizer.from_str(spec.decode())
        self._slow.encode_special_tokens = True
        self._fast = self._ranks(data, pattern)
        chars = byte_of_char()
        vocabulary = data["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in piece)
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b_bytes = [self._piece(self._pieces.id_to_piece(i)) for i in range(self._pieces.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        # Every id as text, before the next id of its side, the other side, the next group and the next window.
        ids = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.names = np.array([[i + mark for i in ids] for mark in ",|;\n"], object)
        self.a_space, self.b_space = (np.fromiter((t[:1] == b" " for t in x), bool, len(x)) for x in (self.a_bytes, self.b_bytes))

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    @staticmethod
    def _ranks(data: dict, pattern: str) -> tiktoken.Encoding | None:
        """The same vocabulary as ranks, if the description is plain enough for ids to be ranks."""
        model, split = data["model"], data.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        plain = data.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
        if not plain or not split.get("use_regex", True) or any(model["vocab"].get(m.replace(" ", "")) != 256 + i for i, m in enumerate(merges)):
            return None
        chars, special = byte_of_char(), {t["content"] for t in data.get("added_tokens", [])}
        ranks = {bytes(chars[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in special}
        return tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        sure = [self._fast is not None and not UNSURE.search(t) for t in texts]
        slow = iter(self._slow.encode_batch([t for t, s in zip(texts, sure) if not s], add_special_tokens=False))
        return [self._fast.encode_ordinary(t) if s else next(slow).ids for t, s in zip(texts, sure)]

    def both(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both, or none if the joined bytes are not those of a space and the text."""
        if not text:
            return [], []
        whole = " " + text
        a, b = self.a_ids([whole])[0], self._pieces.encode(text)
        raw = whole.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return [], []
        return a, b


@lru_cache(maxsize=2)
def tokenizers(spec: bytes, model: bytes, pattern: str) -> Tokenizers:
    return Tokenizers(spec, model, pattern)


class Shared:
    """Both files' bytes (a few MB, whatever the corpus), read once on the driver and broadcast."""

    def __init__(self, spark: SparkSession, spec: str, model: str, pattern: str):
        with open(spec, "rb") as a, open(model, "rb") as b:
            self._files = spark.sparkContext.broadcast((a.read(), b.read(), pattern))

    @property
    def tokenizers(self) -> Tokenizers:
        return tokenizers(*self._files.value)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class Windows:
    """Memory of window alignments by id tuples, numbered in order of first sight, and the pairs they link."""

    def __init__(self, coder: Tokenizers):
        self._coder = coder
        self._numbers: dict[bytes, int] = {}
        self._pair_numbers: dict[int, int] = {}
        self.texts: list[str] = []
        self.groups, self.links, self._start, self._pair, self._times = array("q"), array("q"), array("q", [0]), array("q"), array("q")

    def __len__(self) -> int:
        return len(self.texts)

    def numbers(self, a: np.ndarray, b: np.ndarray, a_spans: np.ndarray, b_spans: np.ndarray) -> np.ndarray:
        """The numbers of different windows, given as (start, stop) rows into both sides' ids."""
        known, a_raw, b_raw = self._numbers, a.astype(np.int32).tobytes(), b.astype(np.int32).tobytes()
        # An id tuple is kept as its packed integers; -1, which is no id, stands between both sides.
        spans = zip((4 * a_spans).tolist(), (4 * b_spans).tolist())
        keys = [b"".join((a_raw[i:x], b"\xff\xff\xff\xff", b_raw[j:y])) for (i, x), (j, y) in spans]
        out = np.array([known.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = np.arange(len(new)) + len(self.texts)
            known.update((keys[i], n) for i, n in zip(new.tolist(), out[new].tolist()))
            sides = [(ids[_ranges(spans[new, 0], np.diff(spans[new])[:, 0])], np.diff(spans[new])[:, 0]) for ids, spans in ((a, a_spans), (b, b_spans))]
            self._learn(*sides[0], *sides[1])
        return out

    def _learn(self, a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> None:
        """Align windows, whose ids follow one another, by the ends that both sides share."""
        coder = self._coder
        i, j = shared_ends(coder, a, b)  # the last tokens of each group
        a_from, b_from = np.concatenate(([0], i[:-1] + 1)), np.concatenate(([0], j[:-1] + 1))
        n, m = i + 1 - a_from, j + 1 - b_from
        last = np.isin(i, np.cumsum(a_sizes) - 1)  # of a window
        window = np.concatenate(([0], np.cumsum(last)[:-1]))

        pieces = np.empty(len(a) + len(b), object)
        a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_mark[i], b_mark[j] = 1, np.where(last, 3, 2)
        group_of_a, group_of_b = np.repeat(np.arange(len(i)), n), np.repeat(np.arange(len(i)), m)
        pieces[np.arange(len(a)) + b_from[group_of_a]] = coder.names[a_mark, a]
        pieces[np.arange(len(b)) + i[group_of_b] + 1] = coder.names[b_mark, b]
        self.texts += "".join(pieces.tolist()).split("\n")[:-1]
        self.groups.frombytes(np.bincount(window, minlength=len(a_sizes)).astype(np.int64).tobytes())
        links = np.zeros(len(a_sizes), np.int64)
        np.add.at(links, window, n * m)
        self.links.frombytes(links.tobytes())

        # Short groups link token by token; a long one has few different ids, and each pair of them once here.
        short = np.flatnonzero(n * m <= LONG)
        each = (n * m)[short]
        place, group = _ranges(np.zeros(len(short), np.int64), each), np.repeat(short, each)
        codes = [a[a_from[group] + place // m[group]] << 32 | b[b_from[group] + place % m[group]]]
        owners, times = [window[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(n * m > LONG).tolist():
            (x, p), (y, q) = (np.unique(ids[lo : lo + size], return_counts=True) for ids, lo, size in ((a, a_from[g], n[g]), (b, b_from[g], m[g])))
            codes.append((x[:, None] << 32 | y[None, :]).ravel())
            times.append(np.multiply.outer(p, q).ravel())
            owners.append(np.full(len(codes[-1]), window[g]))
        code, owner, time = (np.concatenate(x) for x in (codes, owners, times))
        order = np.argsort(owner, kind="stable")
        distinct, again = np.unique(code[order], return_inverse=True)
        numbers = self._pair_numbers
        self._pair.frombytes(np.array([numbers.setdefault(c, len(numbers)) for c in distinct.tolist()], np.int64)[again].tobytes())
        self._times.frombytes(time[order].tobytes())
        self._start.frombytes((np.cumsum(np.bincount(owner, minlength=len(a_sizes))) + self._start[-1]).astype(np.int64).tobytes())

    def pairs(self) -> np.ndarray:
        return np.fromiter(self._pair_numbers, np.int64, len(self._pair_numbers))

    def linked(self, windows: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair number, links) for the distinct pairs of each document, in order of both."""
        start, pair, times = (np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (self._start[:], self._pair[:], self._times[:]))
        sizes = start[windows + 1] - start[windows]
        at = _ranges(start[windows], sizes)
        n = max(1, len(self._pair_numbers))
        code = np.repeat(owner, sizes) * n + pair[at]
        order = np.argsort(code, kind="stable")
        code, total = code[order], times[at][order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        return code[first] // n, code[first] % n, np.add.reduceat(total, first) if len(first) else total


def shared_ends(coder: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of A and of B that end at the same byte."""
    a_ends, b_ends = np.cumsum(coder.a_sizes[a]), np.cumsum(coder.b_sizes[b])
    at = np.minimum(np.searchsorted(b_ends, a_ends), max(0, len(b) - 1))
    i = np.flatnonzero(b_ends[at] == a_ends) if len(a) else np.zeros(0, np.int64)
    return i, at[i]


def cut(coder: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the tokens of whole documents in a row: the places after each window's last token, in A and in B."""
    i, j = shared_ends(coder, a, b)
    marked = (i + 1 == len(a)) | coder.a_space[a[np.minimum(i + 1, len(a) - 1)]] & coder.b_space[b[np.minimum(j + 1, len(b) - 1)]]
    return i[marked] + 1, j[marked] + 1


def _starts_and_places(stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window's first token, and each token's window and place in it."""
    starts = np.concatenate(([0], stops[:-1]))
    owner = np.repeat(np.arange(len(stops)), stops - starts)
    return starts, owner, np.arange(len(owner)) - starts[owner]


def numbered(windows: Windows, a: np.ndarray, b: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray) -> np.ndarray:
    """The number of each window; equal windows, found by a hash and compared id by id, are looked up once."""
    if not len(a_stops):
        return np.zeros(0, np.int64)
    sides, code = [], np.zeros(len(a_stops), np.uint64)
    for ids, stops, seed in ((a, a_stops, 1), (b, b_stops, 2)):
        starts, owner, place = _starts_and_places(stops)
        sides.append((ids, starts, owner, place))
        with np.errstate(over="ignore"):
            code = code * np.uint64(0x9E3779B97F4A7C15) + np.add.reduceat(_mix((ids * 4 + seed).astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))), starts)
    _, first, again = np.unique(code, return_index=True, return_inverse=True)
    same = np.array_equal(np.diff(a_stops, prepend=0), np.diff(a_stops, prepend=0)[first][again])
    same = same and np.array_equal(np.diff(b_stops, prepend=0), np.diff(b_stops, prepend=0)[first][again])
    same = same and all(np.array_equal(ids, ids[starts[first[again]][owner] + place]) for ids, starts, owner, place in sides)
    if not same:  # two different windows share a hash: tell them apart by their ids
        a_list, b_list, seen = a.tolist(), b.tolist(), {}
        bounds = zip(*(x.tolist() for x in (sides[0][1], a_stops, sides[1][1], b_stops)))
        again = np.array([seen.setdefault((tuple(a_list[i:x]), tuple(b_list[j:y])), len(seen)) for i, x, j, y in bounds])
        first = np.unique(again, return_index=True)[1]
    spans = [np.column_stack((starts[first], stops[first])) for (_, starts, _, _), stops in zip(sides, (a_stops, b_stops))]
    return windows.numbers(a, b, *spans)[again]


ROW = """chunk string, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>,
    digest array<string>, pairs array<bigint>, holders array<bigint>, ends binary, pair binary, times binary"""


class _Chunk:
    def __init__(self, coder: Tokenizers, windows: Windows):
        self.coder, self.windows, self.size = coder, windows, 0
        self.columns: dict[str, list] = {c: [] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "digest")}
        self.owner, self.pair, self.times = [], [], []

    def add(self, ids: list, texts: list[str]) -> None:
        coded = [self.coder.both(t) for t in texts]
        base, out = len(self.columns["doc_id"]), self.columns
        a, b = (np.fromiter(chain.from_iterable(c[k] for c in coded), np.int64) for k in (0, 1))
        n_a, n_b = (np.array([len(c[k]) for c in coded], np.int64) for k in (0, 1))
        a_stops, b_stops = cut(self.coder, a, b)
        windows = numbered(self.windows, a, b, a_stops, b_stops)
        found = windows.tolist()
        owner = np.searchsorted(np.cumsum(n_a), a_stops)  # documents without tokens own no window
        names, stops = self.windows.texts, np.searchsorted(owner, np.arange(len(ids)), side="right")
        for k, (lo, hi) in enumerate(zip(np.concatenate(([0], stops[:-1])).tolist(), stops.tolist())):
            joined = ";".join([names[w] for w in found[lo:hi]])
            out["digest"].append(hashlib.sha256(joined.encode()).hexdigest() if n_a[k] else "")
        for name, table in (("n_groups", self.windows.groups), ("n_links", self.windows.links)):
            sums = np.concatenate(([0], np.cumsum(np.array(table, np.int64)[windows]))) if len(windows) else np.zeros(1, np.int64)
            ends = sums[stops]
            out[name] += np.diff(ends, prepend=0).tolist()
        out["doc_id"] += ids
        out["n_a"] += n_a.tolist()
        out["n_b"] += n_b.tolist()
        doc, pair, times = self.windows.linked(windows, owner)
        self.owner.append(doc + base)
        self.pair.append(pair)
        self.times.append(times)
        self.size += sum(map(len, texts))

    def row(self, name: str) -> pa.RecordBatch:
        owner, pair, times = (np.concatenate(x) for x in (self.owner, self.pair, self.times))
        pairs, pair = np.unique(pair, return_inverse=True)  # those of this chunk, of all that the task remembers
        pairs = self.windows.pairs()[pairs]
        ends = np.cumsum(np.bincount(owner, minlength=len(self.columns["doc_id"])))
        lists = {c: pa.array([v], pa.list_(pa.string() if c == "digest" else pa.int64())) for c, v in self.columns.items()}
        whole = pa.list_(pa.int64())
        return pa.RecordBatch.from_pydict(
            {"chunk": [name]} | lists | {
                "pairs": pa.array([pairs], whole), "holders": pa.array([np.bincount(pair, minlength=len(pairs))], whole),
                "ends": [ends.astype(np.int64).tobytes()], "pair": [pair.astype(np.int32).tobytes()],
                "times": [times.astype(np.int64 if len(times) and times.max() > 2**31 - 1 else np.int32).tobytes()],
            }
        )


def align(docs: DataFrame, shared: Shared, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows (``ROW``): the documents' own numbers, the chunk's id pairs, and which document links which how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, n = shared.tokenizers, TaskContext.get().partitionId(), 0
        now = _Chunk(coder, Windows(coder))
        for batch in small(batches, most=SLICE):
            now.add(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            if now.size >= chunk:
                yield now.row(f"{part}-{n}")
                now, n = _Chunk(coder, now.windows if len(now.windows) < REMEMBERED else Windows(coder)), n + 1
        if now.columns["doc_id"]:
            yield now.row(f"{part}-{n}")

    return documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, ROW)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(key, n_docs, best): documents that link the ids of ``key`` (A id << 32 | B id), and whether no pair of its A id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p")).select(F.col("p.pairs").alias("key"), F.col("p.holders").alias("n"))
    counts = stage(each.groupBy("key").agg(F.sum("n").alias("n_docs")).withColumn("a", F.shiftright("key", 32)), "pair-counts")
    top = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(top, "a").select("key", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def aligned_documents(docs: DataFrame, shared: Shared, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    chunks = stage(align(docs, shared, chunk), "aligned")
    ready = looked_up(chunks, "pairs", pair_counts(chunks), ["n_docs", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                pairs, found = row["pairs"].values.to_numpy(zero_copy_only=False), row["found"].values
                counts, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
                if found is not None and len(found):
                    order = np.argsort(pairs)
                    at = order[np.searchsorted(pairs[order], found.field("key").to_numpy())]
                    counts[at], best[at] = found.field("n_docs").to_numpy(), found.field("best").to_numpy(zero_copy_only=False)
                ends, pair = np.frombuffer(row["ends"].as_py(), np.int64), np.frombuffer(row["pair"].as_py(), np.int32)
                times = np.frombuffer(raw := row["times"].as_py(), np.int32 if len(raw) == 4 * len(pair) else np.int64).astype(np.int64)

                def per_document(values: np.ndarray) -> pa.Array:
                    return pa.array(np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0), pa.int64())

                yield pa.RecordBatch.from_arrays(
                    [*(row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
                     per_document(times * best[pair]), per_document(times * counts[pair]), row["digest"].values],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return ready.select("pairs", "found", "ends", "pair", "times", "doc_id", "n_a", "n_b", "n_groups", "n_links", "digest").mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    )
