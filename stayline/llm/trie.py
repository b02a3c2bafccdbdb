"""Prefix trie of conversations by range minima over sorted common-prefix lengths.

Every turn becomes a digest, a conversation the string of its digests. Distinct strings are
range-partitioned in sorted order; a bucket is one task's work. Between neighbours stands the
number of turns they share (LCP). Every prefix of a string is a candidate; with a sparse table
of minima over the LCPs it binary-searches, independently of all others, how far its
members reach to the left and to the right. Everything asked of a node is a difference of
prefix sums or a range minimum over that interval. No stack, no pointers.

A prefix whose interval touches a bucket's edge has members in the neighbouring buckets. Only
these, at most the prefixes of a bucket's first and last string, are merged by a digest of the
prefix; all counts add up over the pieces, as a node's own share is taken by the bucket in which
it begins. Nodes inside a bucket are done where they are. Of the rest of the trie a task sees
the two strings at its edges, so a first turn that all conversations share costs nothing more.

Defined results: rows without conv_id belong to no conversation. Null roles and texts are empty.
Turns are ordered by turn (null first); ties by role, then by the turn's digest; repeated rows
are turns each. ``c - c % 5`` truncates towards zero, so conversation -3 begins with 0.
Conversations without turns are members of the root alone. An empty table has no nodes, not even
a root. Turns are equal if 128 bits of a SHA-256 over role and text are. Other columns are ignored.
A task holds one conversation's digests (16 bytes a turn), and hashes the ids of one group of
equal conversations in a stream: SHA-256 over ids in order can't be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stayline.operators.running import bucketed
from stayline.session import stage

DIGEST = 16  # bytes of a turn
MOST = 9  # fixed: a conversation takes fewer than nine turns of the one its block begins with
BLOCK = 5  # fixed: conversations of a block


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token, size): numbered turns, each with a digest of role and text and the text's bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.substring(F.sha2(named, 256), 1, 2 * DIGEST).alias("token"), F.octet_length(text).cast("bigint").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "token")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "token", "size")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): each conversation after its block's first turns have replaced its own.

    ``key`` is the string of the turns' digests, ``sizes`` the bytes of their texts.
    """
    rows = stage(turns(conversations), "turns")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST
    heads = rows.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).withColumn("h", taken)
    lent = rows.where(F.col("pos") < MOST).select(F.col("conv_id").alias("base"), "pos", "token", "size")
    borrowed = heads.where("base <> conv_id").join(lent, "base").where("pos < h").select("conv_id", "pos", "token", "size")
    own = rows.where((F.col("conv_id") % BLOCK == 0) | (F.col("pos") >= taken))
    marks = heads.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("token"), F.lit(0).cast("bigint").alias("size"))
    whole = own.unionByName(borrowed).unionByName(marks).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "size"))).alias("t"))
    kept = F.filter("t", lambda x: x["pos"] >= 0)
    return whole.select("conv_id", F.unhex(F.array_join(F.transform(kept, lambda x: x["token"]), "")).alias("key"), F.transform(kept, lambda x: x["size"]).alias("sizes"))


def member_digests(members: DataFrame) -> DataFrame:
    """(name, ends): SHA-256 of the ascending, comma-joined conv_ids of each ``name``, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            names, ids = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()
            done: list[tuple[bytes, str]] = []
            stops = [i for i in range(1, len(names)) if names[i] != names[i - 1]] + [len(names)]
            start = 0
            for stop in stops if names else []:
                if names[start] != name:
                    if state is not None:
                        done.append((name, state.hexdigest()))
                    name, state = names[start], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(map(str, ids[start:stop])).encode())
                start = stop
            yield pa.RecordBatch.from_pydict({"name": pa.array([d[0] for d in done], pa.binary()), "ends": pa.array([d[1] for d in done], pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "ends": [state.hexdigest()]})

    return members.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(run, "name binary, ends string")


class RangeMinimum:
    """Sparse table: minima over all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minimum over each closed range."""
        level = np.frexp(right - left + 1)[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - (1 << k) + 1])
        return out

    def reach_right(self, start: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The last place up to which all values after ``start`` are at least ``floor``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            fits = at + 1 < len(table)
            go = fits & (table[np.where(fits, at + 1, 0)] >= floor)
            at[go] += 1 << k
        return at

    def reach_left(self, start: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The first place from which on all values up to and with ``start``'s are at least ``floor``, less one."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, first = self.levels[k], at - (1 << k) + 1
            fits = first >= 0
            go = fits & (table[np.where(fits, first, 0)] >= floor)
            at[go] -= 1 << k
        return at


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of digests at which two strings agree from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // DIGEST


def prefix_names(key: bytes, depth: int) -> list[bytes]:
    """A digest of each prefix of up to ``depth`` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(state.copy().digest()[:DIGEST])
        state.update(key[d * DIGEST : (d + 1) * DIGEST])
    return out


PIECES = """bucket int, open binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,
    n_leaves bigint, saved_tokens bigint, ends string"""


def bucket_nodes(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """All prefixes of a bucket's strings with what the bucket knows of them.

    ``rows`` (key, conv_id, n, sizes, ends) are distinct strings: smallest member, members,
    bytes of the turns, digest of the members. ``edges`` holds the last string before the
    bucket and the first after it (null at the ends of the order). A piece that reaches an
    edge has an ``open`` name and its parent's.
    """
    keys = rows.column("key").to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys = [keys[i] for i in order]
    m = len(keys)
    take = rows.take(pa.array(order, pa.int64()))
    ids, members = (take.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "n"))
    ends, size_lists = take.column("ends").to_pylist(), take.column("sizes").to_pylist()
    before, after = (edges.column(c)[0].as_py() for c in ("before", "after"))
    lens = np.array([len(k) // DIGEST for k in keys], np.int64)
    lcp = np.empty(m + 1, np.int64)  # with the string before, and at last with the one after the bucket
    lcp[0] = -1 if before is None else shared_turns(before, keys[0])
    lcp[1:m] = [shared_turns(a, b) for a, b in zip(keys, keys[1:])]
    lcp[m] = -1 if after is None else shared_turns(keys[-1], after)
    inner = lcp[:m].copy()
    inner[0] = -1  # nothing reaches beyond the bucket's first string from within

    low = inner + 1  # the depths from which on a string's prefixes begin with it
    sizes_n = lens - low + 1
    base = np.cumsum(sizes_n) - sizes_n
    row = np.repeat(np.arange(m), sizes_n)
    depth = np.arange(len(row)) - base[row] + low[row]
    table = RangeMinimum(inner)
    left, right = table.reach_left(row, depth), table.reach_right(row, depth)
    if not np.array_equal(left, row):
        raise AssertionError("a prefix begins before its first string")
    own = (row > 0) | (depth > lcp[0])  # the node begins here
    up = np.where(depth > 0, depth - 1, 0)
    parent_row = table.reach_left(row, up)
    parent = base[parent_row] + up - low[parent_row]

    children = np.bincount(parent[own & (depth > 0)], minlength=len(row))
    before_n = np.concatenate(([0], np.cumsum(members)))
    n = before_n[right + 1] - before_n[left]
    smallest = RangeMinimum(ids).least(left, right)
    leaves = np.concatenate(([0], np.cumsum(lcp[1:] < lens)))
    flat, start = np.array([x for s in size_lists for x in s] + [0], np.int64), np.cumsum(lens) - lens
    last = np.where(depth > 0, flat[np.where(depth > 0, start[row] + depth - 1, 0)], 0)
    worth = np.concatenate(([0], np.cumsum(n * last - np.where(own, last, 0))))
    saved = worth[base[right] + sizes_n[right]] - worth[np.arange(len(row))]

    is_open = (row == 0) & (depth <= lcp[0]) | (right == m - 1) & (depth <= lcp[m])
    first_names, last_names = prefix_names(keys[0], max(0, int(lcp[0]))), prefix_names(keys[-1], max(0, int(lcp[m])))
    names: list[bytes | None] = [None] * len(row)
    for i in np.flatnonzero(is_open).tolist():
        d = int(depth[i])
        names[i] = first_names[d] if row[i] == 0 and d <= lcp[0] else last_names[d]
    has_parent = depth > 0
    up_names = [names[p] if has else None for p, has in zip(parent.tolist(), has_parent.tolist())]
    ended = [ends[r] if d == z else None for r, d, z in zip(row.tolist(), depth.tolist(), lens[row].tolist())]
    return pa.table(
        {
            "bucket": pa.array(np.full(len(row), rows.column("_bucket")[0].as_py()), pa.int32()), "open": pa.array(names, pa.binary()),
            "parent": pa.array(up_names, pa.binary()), "depth": depth, "conv_id": smallest,
            "parent_conv_id": pa.array(smallest[parent], pa.int64(), mask=~has_parent), "n_convs": n, "n_children": pa.array(children, pa.int64()),
            "n_leaves": leaves[right + 1] - leaves[left], "saved_tokens": saved, "ends": pa.array(ended, pa.string()),
        }
    )


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over (conv_id, key, sizes)."""
    rows = stage(sequences.withColumn("name", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * DIGEST))), "sequences")
    distinct = rows.groupBy("name", "key", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    strings = bucketed(distinct.join(member_digests(rows), "name").drop("name"), ["key"], name="strings")
    # One row per bucket, so no more than there are shuffle partitions.
    in_order = Window.orderBy("_bucket")
    edges = strings.groupBy("_bucket").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    edges = edges.select("_bucket", F.lag("last").over(in_order).alias("before"), F.lead("first").over(in_order).alias("after"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return bucket_nodes(left, right)

    pieces = stage(strings.groupBy("_bucket").cogroup(edges.groupBy("_bucket")).applyInArrow(run, PIECES), "pieces")
    ends = F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    inner = pieces.where("open IS NULL")
    merged = stage(
        pieces.where("open IS NOT NULL").groupBy("open").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        ),
        "open-nodes",
    )
    known = merged.select(F.col("open").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A bucket's own copy of its open nodes: no parent has more rows than a bucket holds.
    local = pieces.where("open IS NOT NULL").select("bucket", F.col("open").alias("parent")).join(known, "parent")
    under_open = inner.where("parent IS NOT NULL").drop("parent_conv_id").join(local, ["bucket", "parent"])
    parts = [inner.where("parent IS NULL"), under_open, merged.join(known, "parent", "left")]
    whole = [p.withColumn("ends_sha256", ends).select(*NODE) for p in parts]
    return whole[0].unionByName(whole[1]).unionByName(whole[2])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations."""
    return nodes_of(rebuilt(conversations))
