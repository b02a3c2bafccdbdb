"""Arrow batches of texts, cut to a bounded size, and a columnar view of their words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

SPACES = b" \t\n\r\x0b\x0c"  # the separators of [^\x20\x09-\x0D]+, which are also those of bytes.split()
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """Id and text of every row; a null text is empty. Other columns, whatever their names, are left out."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def small(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """The words of some texts as flat arrays, in text order."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        raw = [t.encode() for t in texts]
        self.buffer = b"\n".join(raw) + b"\n"
        self.bytes = np.frombuffer(self.buffer, np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.text_ends = np.cumsum(sizes + 1) - 1
        self.text_starts = self.text_ends - sizes
        self.n = len(texts)

    @cached_property
    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        space = np.zeros(256, bool)
        space[list(SPACES)] = True
        inside = ~space[self.bytes]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
        return edges[0::2], edges[1::2]

    @cached_property
    def code_points(self) -> np.ndarray:
        """Code points before each byte offset."""
        return np.concatenate(([0], np.cumsum((self.bytes & 0xC0) != 0x80)))

    @cached_property
    def lengths(self) -> np.ndarray:
        starts, ends = self._bounds
        return self.code_points[ends] - self.code_points[starts]

    @cached_property
    def text_of(self) -> np.ndarray:
        return np.searchsorted(self.text_ends, self._bounds[0])

    @cached_property
    def counts(self) -> np.ndarray:
        return np.bincount(self.text_of, minlength=self.n)

    @cached_property
    def ids(self) -> np.ndarray:
        """Equal words, and only they, have equal numbers."""
        words = self.buffer.split()
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """True bytes of each text."""
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[self.text_ends] - total[self.text_starts]

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Sum over each text's words."""
        return np.bincount(self.text_of, weights=values, minlength=self.n)

    def repeated(self, n: int) -> np.ndarray:
        """Words that lie in a window of ``n`` words found twice or more in the same text.

        Windows are compared by a rolling hash; equal hashes are checked word by word, and
        a batch with a collision is sorted by the words themselves.
        """
        ids, text = self.ids, self.text_of
        m = len(ids) - n + 1
        marks = np.zeros(len(ids) + 1, np.int64)
        if m <= 0:
            return marks[:-1].astype(bool)
        with np.errstate(over="ignore"):
            mixed = _mix(ids.astype(np.uint64))
            rolled = np.zeros(m, np.uint64)
            for j in range(n):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + mixed[j : j + m]
            rolled ^= _mix(text[:m].astype(np.uint64) + np.uint64(1 << 40))
        at = np.flatnonzero(text[:m] == text[n - 1 :])
        order = at[np.argsort(rolled[at], kind="stable")]
        a, b = order[:-1], order[1:]
        same = rolled[a] == rolled[b]
        a, b = a[same], b[same]
        if not (np.array_equal(text[a], text[b]) and all(np.array_equal(ids[a + j], ids[b + j]) for j in range(n))):
            keys = [ids[at + j] for j in range(n)] + [text[at]]
            order = at[np.lexsort(keys)]
            a, b = order[:-1], order[1:]
            same = text[a] == text[b]
            for j in range(n):
                same &= ids[a + j] == ids[b + j]
            a, b = a[same], b[same]
        found = np.zeros(len(ids), bool)
        found[a] = found[b] = True
        starts = np.flatnonzero(found)
        np.add.at(marks, starts, 1)
        np.subtract.at(marks, starts + n, 1)
        return np.cumsum(marks[:-1]) > 0

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: lines that hold a word, those equal to an earlier one, and the code points of the latter."""
        total, equal, chars = (np.zeros(self.n, np.int64) for _ in range(3))
        for i, text in enumerate(self.texts):
            lines = text.split("\n")
            kept = [x for x in lines if x.strip(" \t\n\r\x0b\x0c")]
            total[i] = len(kept)
            if len(kept) > 1 and len(distinct := set(kept)) < len(kept):
                equal[i] = len(kept) - len(distinct)
                chars[i] = sum(map(len, kept)) - sum(map(len, distinct))
        return total, equal, chars


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing step."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))
