"""Line dedup by content-defined chunks of lines.

A chunk ends after a line where a rolling hash over the last ``WINDOW`` lines' hashes is 0
modulo ``EVERY``. Boundaries thus depend on the lines around them only, so lines added
elsewhere in a text shift no chunk. A chunk of two or more lines that occurs more than once
in the whole table stays at its first occurrence, by (doc_id, place), and is cut out
everywhere else. Hashes only nominate chunks: those of one hash are compared byte by byte,
and stay if they differ.

:func:`cut_passages` cuts more, for the pipeline: also every line of over ``LONG`` words that
stands earlier, and every run of lines of over ``LONG`` words in all of which each two
neighbours stand, one after the other, earlier. So a passage of two or more lines that an
earlier text holds line for line goes whole, however chunks are cut around it. Earlier is by
(doc_id, line); the first of equal lines always stays. Lines and neighbours are equal if the
first 128 bits of their SHA-256 are.

Built of DataFrame functions. Ids, places and hashes are shuffled for all chunks, the text
of a chunk only if its hash repeats, each task first merging equal copies, so a chunk that a
third of all texts share is a few rows when it meets the others.

A null text stays null and an empty text empty; a text may become empty. Rows that repeat a
doc_id and a text count as one text, and fare alike. A row with a null doc_id is left whole
and does not count. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stayline.llm.columns import any_columns
from stayline.session import stage

WINDOW, EVERY = 2, 3
LONG = 50  # words
STEP, PRIME = 1_000_003, 2_147_483_647


def _value(line: Column) -> Column:
    """28 bits of a line's digest, which any SQL engine can compute too."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("bigint")


def chunked(docs: DataFrame, window: int = WINDOW, every: int = EVERY) -> DataFrame:
    """The rows with ``__lines`` and ``__ends``: the lines and the (0-based) last line of each chunk."""
    lined = docs.withColumn("__lines", F.split("text", "\n", -1)).withColumn("__values", F.transform("__lines", _value))
    values = F.col("__values")

    def cut(i: Column) -> Column:
        rolled = F.get(values, i)
        for back in range(1, window):
            earlier = F.coalesce(F.get(values, F.when(i >= back, i - back)), F.lit(0))
            rolled = (earlier * (STEP**back % PRIME) + rolled) % PRIME
        return (i == F.size(values) - 1) | (rolled % every == 0)

    return lined.withColumn("__ends", F.filter(F.sequence(F.lit(0), F.size(values) - 1), cut)).drop("__values")


def _starts() -> Column:
    """First line of each chunk."""
    ends = F.col("__ends")
    return F.concat(F.array(F.lit(0)), F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda e: e + 1))


def _bounds(rows: DataFrame) -> DataFrame:
    """``__bounds``: place, first and last line of each chunk."""
    return rows.withColumn("__bounds", F.arrays_zip(_starts().alias("start"), F.col("__ends").alias("stop"))).withColumn(
        "__bounds", F.transform("__bounds", lambda b, k: F.struct(k.alias("place"), b["start"].alias("start"), b["stop"].alias("stop")))
    )


def _chunk_text(lines: Column, start: Column, stop: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, stop - start + 1), "\n")


def occurrences(docs: DataFrame, window: int = WINDOW, every: int = EVERY) -> DataFrame:
    """(doc_id, place, key) of every chunk of two or more lines."""
    text = _chunk_text(F.col("__lines"), F.col("__b.start"), F.col("__b.stop"))
    return (
        _bounds(chunked(docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL"), window, every))
        .select("doc_id", "__lines", F.explode(F.filter("__bounds", lambda b: b["stop"] > b["start"])).alias("__b"))
        .select("doc_id", F.col("__b.place").alias("place"), F.xxhash64(text).alias("key"))
    )


def repeated(docs: DataFrame, window: int = WINDOW, every: int = EVERY) -> DataFrame:
    """(doc_id, places): the chunks to cut out of each text, found equal to an earlier one."""
    all_chunks = stage(occurrences(docs, window, every).distinct(), "line-chunks")
    again = all_chunks.groupBy("key").count().where("count > 1").select("key")
    suspects = stage(all_chunks.join(again, "key"), "line-suspects")

    wanted = suspects.groupBy("doc_id").agg(F.collect_list("place").alias("__wanted"))  # a text's own chunks
    rows = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").join(wanted.hint("merge"), "doc_id")
    text = _chunk_text(F.col("__lines"), F.col("__b.start"), F.col("__b.stop"))
    seen = (
        _bounds(chunked(rows, window, every))
        .select(
            "doc_id", "__lines",
            F.explode(F.filter("__bounds", lambda b: F.array_contains("__wanted", b["place"]) & (b["stop"] > b["start"]))).alias("__b"),
        )
        .select("doc_id", F.col("__b.place").alias("place"), text.alias("bytes"))
        .withColumn("key", F.xxhash64("bytes"))
    )
    # Equal bytes under one key: the least and the greatest text are the same.
    same = (
        seen.groupBy("key")
        .agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"), F.min(F.struct("doc_id", "place")).alias("first"))
        .where("low = high")
        .select("key", "first")
    )
    return (
        suspects.join(same, "key")
        .where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("place") != F.col("first.place")))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("place", "key")).alias("__gone"))
    )


@any_columns
def cut_repeats(docs: DataFrame, window: int = WINDOW, every: int = EVERY) -> DataFrame:
    """The rows with ``text`` less its repeated chunks, and the extra columns ``__n_lines`` and ``__n_removed``."""
    gone = stage(repeated(docs, window, every), "line-repeats").withColumnRenamed("doc_id", "__id")
    # Merge joins at every size: what is cut out grows with the table, so it is never broadcast.
    rows = _bounds(chunked(docs.join(gone.hint("merge"), docs["doc_id"] == gone["__id"], "left"), window, every))
    lines = F.col("__lines")

    def stays(b: Column) -> Column:
        key = F.struct(b["place"].alias("place"), F.xxhash64(_chunk_text(lines, b["start"], b["stop"])).alias("key"))
        return ~F.array_contains("__gone", key)

    kept = rows.withColumn("__kept", F.when(F.col("__gone").isNotNull(), F.filter("__bounds", stays)))
    parts = F.flatten(F.transform("__kept", lambda b: F.slice(lines, b["start"] + 1, b["stop"] - b["start"] + 1)))
    left = kept.withColumn("__left", F.when(F.col("__kept").isNotNull(), parts))
    return left.select(
        *(F.coalesce(F.array_join("__left", "\n"), "text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("bigint").alias("__n_lines"),
        F.coalesce(F.when(F.col("__left").isNotNull(), F.size("__lines") - F.size("__left")), F.lit(0)).cast("bigint").alias("__n_removed"),
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def _unit(lines: Column, at: Column, size: Column) -> Column:
    """Digest of one line, or of two neighbours, which hold a line break more."""
    return _digest(F.when(size == 1, F.get(lines, at)).otherwise(F.concat(F.get(lines, at), F.lit("\n"), F.get(lines, at + 1))))


def repeated_units(docs: DataFrame, long: int = LONG) -> DataFrame:
    """(doc_id, __units): places and digests of the long lines and neighbours that stand earlier."""
    lined = docs.select("doc_id", F.split("text", "\n", -1).alias("__lines")).where("doc_id IS NOT NULL AND __lines IS NOT NULL")
    lines = F.col("__lines")
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    pairs = F.transform(F.filter(places, lambda i: i < F.size(lines) - 1), lambda i: F.struct(i.alias("at"), F.lit(2).alias("size")))
    singles = F.transform(F.filter(places, lambda i: _words(F.get(lines, i)) > long), lambda i: F.struct(i.alias("at"), F.lit(1).alias("size")))
    units = stage(
        lined.select("doc_id", "__lines", F.explode(F.concat(pairs, singles)).alias("__u"))
        .select("doc_id", F.col("__u.at").alias("at"), F.col("__u.size").alias("size"), _unit(lines, F.col("__u.at"), F.col("__u.size")).alias("key"))
        .distinct(),
        "line-units",
    )
    firsts = units.groupBy("key").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        units.join(firsts.select("key", "first"), "key")
        .where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("at") != F.col("first.at")))
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", "size", "key"))).alias("__units"))
    )


def _run_lines(lines: Column, pairs: Column, long: int) -> Column:
    """Lines of the runs of over ``long`` words; ``pairs`` holds the first lines of repeated neighbours, ascending."""

    def of(s: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(s) - 1)
        begins = F.filter(numbers, lambda j: (j == 0) | (F.get(s, j) != F.get(s, F.when(j > 0, j - 1)) + 1))
        stops = F.concat(F.transform(F.slice(begins, 2, F.greatest(F.size(begins) - 1, F.lit(0))), lambda j: j - 1), F.array(F.size(s) - 1))
        runs = F.zip_with(begins, stops, lambda a, b: F.struct(F.get(s, a).alias("start"), (F.get(s, b) + 1).alias("stop")))
        wordy = F.filter(runs, lambda r: _words(_chunk_text(lines, r["start"], r["stop"])) > long)
        return F.flatten(F.transform(wordy, lambda r: F.sequence(r["start"], r["stop"])))

    # The outer lambda binds the places, which would otherwise be computed at each use.
    none = F.array().cast("array<int>")
    return F.flatten(F.transform(F.array(pairs), lambda s: F.when(F.size(s) > 0, of(s)).otherwise(none)))


@any_columns
def cut_passages(docs: DataFrame, long: int = LONG) -> DataFrame:
    """The rows with ``text`` less its repeated chunks, its repeated long lines and its repeated passages."""
    gone = stage(repeated(docs), "line-repeats").withColumnRenamed("doc_id", "__id")
    units = stage(repeated_units(docs, long), "line-passages").withColumnRenamed("doc_id", "__owner")
    rows = docs.join(gone.hint("merge"), docs["doc_id"] == gone["__id"], "left").join(units.hint("merge"), docs["doc_id"] == units["__owner"], "left")
    lines = F.col("__lines")

    def cut(b: Column) -> Column:
        key = F.struct(b["place"].alias("place"), F.xxhash64(_chunk_text(lines, b["start"], b["stop"])).alias("key"))
        return F.array_contains("__gone", key)

    none = F.array().cast("array<int>")
    of_chunks = F.flatten(F.transform(F.filter("__bounds", cut), lambda b: F.sequence(b["start"], b["stop"])))
    found = _bounds(chunked(rows)).withColumn("__of_chunks", F.coalesce(of_chunks, none))
    # An id may have several texts: units count in those that hold them.
    held = found.withColumn("__held", F.filter("__units", lambda u: (u["at"] + u["size"] <= F.size(lines)) & (_unit(lines, u["at"], u["size"]) == u["key"])))
    singles = F.transform(F.filter("__held", lambda u: u["size"] == 1), lambda u: u["at"])
    pairs = F.transform(F.filter("__held", lambda u: u["size"] == 2), lambda u: u["at"])
    passages = F.when(F.col("__held").isNotNull(), F.concat(singles, _run_lines(lines, pairs, long)))
    all_gone = held.withColumn("__all_gone", F.concat("__of_chunks", F.coalesce(passages, none)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__all_gone")
    left = F.when(F.size("__all_gone") > 0, F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return all_gone.select(*(F.coalesce(left, "text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
