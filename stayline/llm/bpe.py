"""Byte-level BPE: encoding of overlapping chunks, decoding by concatenating raw bytes.

A text longer than ``chunk`` characters becomes several chunks that overlap. Chunks are
rows, dealt over the cluster, and pre-tokenised and encoded on their own. Two neighbours
are stitched at the first pre-token boundary in their overlap that both have found: from a
common boundary on, splitting depends only on what follows, so both then agree. Where an
overlap has no common boundary (one pre-token covers it), the text between the last settled
boundary and the end of the next chunk is split again, so the ids are always those of the
whole text. Texts of one chunk need no stitching and are not shuffled.

Null and empty texts have no ids and decode to no bytes. Repeated rows each get their row.
Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from stayline.llm.batches import documents, small

CHUNK, OVERLAP = 32_768, 512  # characters
DECODED = 1 << 20  # ids decoded at a time
TAIL = 64  # a chunk's boundaries this close to its cut end are not trusted


class Codec:
    """A vocabulary of ranks and the pattern that splits text before merging.

    Several worker processes of an executor hold one at a time, so each part is made when it
    is first used: a worker that only decodes has no tokenizer, one that only encodes no tokens.
    """

    def __init__(self, ranks: bytes, pattern: str):
        self._ranks, self._pattern = ranks, pattern

    def _table(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, self._ranks.splitlines())}

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("ranks", pat_str=self._pattern, mergeable_ranks=self._table(), special_tokens={})

    @cached_property
    def pattern(self) -> regex.Pattern:
        return regex.compile(self._pattern)

    @cached_property
    def tokens(self) -> np.ndarray:
        table = self._table()
        tokens = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        return np.array(tokens, object)

    @cached_property
    def sizes(self) -> np.ndarray:
        table = self._table()
        sizes = np.zeros(max(table.values()) + 1, np.int64)
        sizes[list(table.values())] = list(map(len, table))
        return sizes

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), np.int32)

    def boundaries(self, text: str) -> np.ndarray:
        """Character offsets at which a pre-token ends."""
        return np.fromiter((m.end() for m in self.pattern.finditer(text)), np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids].tolist())


@lru_cache(maxsize=4)
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


class Vocabulary:
    """The rank file's bytes (under 1 MB, whatever the corpus), read once on the driver and broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self._ranks: Broadcast[bytes] = spark.sparkContext.broadcast(f.read())
        self._pattern = pattern

    @property
    def codec(self) -> Codec:
        return codec(self._ranks.value, self._pattern)


def chunk_spans(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Chunks of a text: each nominal piece, and ``overlap`` characters on either side."""
    return [(max(0, a - overlap), min(length, a + chunk + overlap)) for a in range(0, max(1, length), chunk)]


def stitch(parts: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]], length: int, coder: Codec) -> np.ndarray:
    """Ids of a text from its chunks (start, end, boundaries, ids up to each boundary, ids), in order.

    Boundaries are offsets in the whole text.
    """
    out: list[np.ndarray] = []
    start, end, bounds, upto, ids = parts[0]
    settled, used = start, 0  # the text up to ``settled`` is encoded; ``used`` ids of this chunk are out
    waiting: list[str] = []  # text from ``settled`` to ``end`` that is yet to be split again
    for i, nxt in enumerate(parts[1:], 1):
        n_start, n_end, n_bounds, n_upto, n_ids = nxt
        if not waiting:
            shared = np.intersect1d(bounds, n_bounds, assume_unique=True)
            shared = shared[(shared > max(settled, n_start)) & (shared <= end - TAIL)] if end < length else shared[shared > settled]
            if len(shared):
                cut = int(shared[0])
                here = int(upto[np.searchsorted(bounds, cut)])
                out.append(ids[used:here])
                settled, used = cut, int(n_upto[np.searchsorted(n_bounds, cut)])
                start, end, bounds, upto, ids = nxt
                continue
            waiting = [coder.decode(ids[used:]).decode()]
            split_again = 2 * len(waiting[0])
        # No common boundary: both chunks' text is split again from the last settled boundary on. A
        # pre-token may cover many chunks, so this waits until the text is twice what was split last.
        waiting.append(coder.decode(n_ids).decode()[end - n_start :])
        end = n_end
        if end - settled >= split_again or i == len(parts) - 1:
            text = "".join(waiting)
            waiting, start, used = [], settled, 0
            bounds = coder.boundaries(text) + settled
            pieces = [coder.encode(text[a - settled : b - settled]) for a, b in zip(np.concatenate(([settled], bounds[:-1])), bounds)]
            upto = np.cumsum([len(p) for p in pieces])
            ids = np.concatenate(pieces)
    out.append(ids[used:])
    return np.concatenate(out)


def _encode_chunk(text: str, offset: int, coder: Codec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bounds = coder.boundaries(text)
    ids = coder.encode(text)
    # Each pre-token is encoded on its own, so the ids' bytes tell which id ends at which boundary.
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)))
    byte_of = np.searchsorted(points, bounds, side="right") - 1
    ends = np.cumsum(coder.sizes[ids])
    upto = np.searchsorted(ends, byte_of) + 1
    return bounds + offset, upto, ids


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) of every row."""
    if overlap <= TAIL or chunk <= 2 * overlap:
        raise ValueError("a chunk must be longer than its overlaps, and an overlap than the untrusted tail")
    texts = documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    long_text = F.length("text") > chunk

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.codec
        for batch in small(batches):
            ids = [coder.encode(t) for t in batch.column("text").to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"]
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``row`` names a row by its task's partition and place, the same when the task runs again.
        part, n = TaskContext.get().partitionId(), 0
        for batch in small(batches):
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                spans = chunk_spans(len(text), chunk, overlap)
                row, n = f"{part}-{n}", n + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([doc] * len(spans), pa.int64()), "row": [row] * len(spans),
                        "start": [a for a, _ in spans], "size": [len(text)] * len(spans), "text": [text[a:b] for a, b in spans],
                    }
                )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.codec
        for batch in small(batches):
            rows = []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("text").to_pylist()):
                bounds, upto, ids = _encode_chunk(text, start, coder)
                rows.append((start + len(text), bounds.tobytes(), upto.astype(np.int64).tobytes(), ids.tobytes()))
            stop, bounds, upto, ids = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "start", "size")), pa.array(stop),
                 pa.array(bounds, pa.binary()), pa.array(upto, pa.binary()), pa.array(ids, pa.binary())],
                names=["doc_id", "row", "start", "size", "stop", "bounds", "upto", "ids"],
            )

    def join(text: pa.Table) -> pa.Table:
        text = text.sort_by("start")
        start, stop, bounds, upto, ids = (text.column(c).to_pylist() for c in ("start", "stop", "bounds", "upto", "ids"))
        parts = [
            (a, b, np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), np.frombuffer(z, np.int32))
            for a, b, x, y, z in zip(start, stop, bounds, upto, ids)
        ]
        whole = stitch(parts, text.column("size")[0].as_py(), vocabulary.codec)
        return pa.table({"doc_id": text.column("doc_id")[:1], "ids": pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), pa.array(whole))})

    short = texts.where(~long_text).mapInArrow(whole, "doc_id bigint, ids array<int>")
    # ``row`` tells repeated rows apart; it lives within this query only.
    chunks = texts.where(long_text).mapInArrow(cut, "doc_id bigint, row string, start bigint, size bigint, text string")
    spread = chunks.repartition("row", "start")
    encoded = spread.mapInArrow(
        pieces, "doc_id bigint, row string, start bigint, size bigint, stop bigint, bounds binary, upto binary, ids binary"
    )
    stitched = encoded.groupBy("row").applyInArrow(join, "doc_id bigint, ids array<int>")
    return short.unionByName(stitched)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", raw: str = "raw") -> DataFrame:
    """The rows with the column ``raw``: the bytes of the ids, one after another (null for null ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.codec
        for batch in batches:
            at = batch.schema.names.index(ids)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:  # about a million ids at a time
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + DECODED, side="right")))
                part = batch.slice(start, stop - start)
                texts = [None if x.as_py() is None else coder.decode(x.values.to_numpy()) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, raw])
                start = stop

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(raw, BinaryType())]))


def digest(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Number and hash of the ids, and hash of what they decode to."""
    return decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )
