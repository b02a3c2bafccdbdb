"""Embedding near-dedup: hierarchical navigable small-world graphs per shard.

Vectors are compared within a label (and a length). Equal vectors are one node with a count.
A label's nodes are dealt by hash into shards of about ``SHARD`` nodes; each shard gets a
graph whose upper levels hold ever fewer nodes. Then every node queries every shard of its
label, in blocks: the beam starts at the top level; what it finds is followed over neighbours
that are still similar enough, so a large group is walked through and not searched for. While
an audit against brute force finds too few links, the block's beams widen; the widest beam
is the whole shard. Nominated pairs are verified by the cosine in
double precision. A task sends a count per query and one link per node it has joined, never
its pairs.

Vectors that are null, zero, or hold a null or a component that is not finite, or whose
label or vec_id is null, link with nothing. Rows that repeat a vec_id are one vector as far
as links are counted. Columns besides ``vec_id``, ``embedding`` and ``label`` are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stayline.llm.components import components
from stayline.llm.simhash import local_roots
from stayline.session import stage

COSINE = 0.93
SHARD, QUERIES = 16_384, 1024  # nodes of a graph; queries of a block
STRAY = 0.03  # by which a node may fall short and still be walked through
WALK = 1 << 15  # pairs whose neighbours are looked at in one step
SLACK = 1e-4  # by which single precision may understate a cosine


@dataclass(frozen=True)
class Shape:
    """Links kept per node, room before they are pruned, and beams; ``audit`` queries of a block are checked by brute force."""

    links: int = 16
    room: int = 32
    build_beam: int = 40
    beam: int = 48
    audit: int = 48
    recall: float = 0.99


class Graph:
    """Unit vectors (single precision), and for each level the neighbours of the nodes on it (-1: none)."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, shape: Shape):
        self.x, self.levels, self.shape = vectors, levels, shape
        self.top = int(levels.max(initial=0))
        self.near = [np.full((len(vectors), shape.room), -1, np.int32) for _ in range(self.top + 1)]
        self.used = [np.zeros(len(vectors), np.int32) for _ in range(self.top + 1)]
        self.entry = int(np.argmax(levels)) if len(levels) else -1

    # -- search ---------------------------------------------------------------------------

    def beam(self, queries: np.ndarray, width: int, level: int, seeds: np.ndarray, at_least: float | None = None):
        """Best-first search of one level by all queries in step.

        Returns the beam's nodes and similarities, best first, and, given ``at_least``, every
        (query, node) seen with at least that similarity; and which nodes each query has seen.
        """
        n, near = len(queries), self.near[level]
        seen = np.zeros((n, len(self.x)), bool)
        ids = np.full((n, width), -1, np.int32)
        sims = np.full((n, width), -np.inf, np.float32)
        done = np.ones((n, width), bool)
        hits: list[np.ndarray] = []

        def visit(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            seen[rows, nodes] = True
            s = np.einsum("nd,nd->n", self.x[nodes], queries[rows])
            if at_least is not None:
                close = s >= at_least
                hits.append(np.column_stack((rows[close], nodes[close])))
            return s

        def merge(active: np.ndarray, nodes: np.ndarray, found: np.ndarray) -> None:
            all_ids = np.concatenate((ids[active], nodes), axis=1)
            all_sims = np.concatenate((sims[active], found), axis=1)
            all_done = np.concatenate((done[active], ~np.isfinite(found)), axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[active], sims[active], done[active] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_sims, all_done))

        seeds = np.sort(seeds, axis=1)
        fresh = seeds >= 0
        fresh[:, 1:] &= seeds[:, 1:] != seeds[:, :-1]
        rows, cols = np.nonzero(fresh)
        start = np.full(seeds.shape, -np.inf, np.float32)
        start[rows, cols] = visit(rows, seeds[rows, cols])
        merge(np.arange(n), seeds, start)
        active = np.arange(n)
        while True:
            active = active[~done[active].all(axis=1)]
            if not len(active):
                break
            take = np.argsort(done[active], axis=1, kind="stable")[:, :4]  # the best that are not expanded yet
            at = active[:, None]
            open_ = ~done[at, take]
            nodes = near[ids[at, take]]
            nodes = np.where(open_[:, :, None], nodes, -1).reshape(len(active), -1)
            done[at, take] = True
            nodes = np.sort(nodes, axis=1)
            fresh = nodes >= 0
            fresh[:, 1:] &= nodes[:, 1:] != nodes[:, :-1]
            fresh &= ~seen[at, np.maximum(nodes, 0)]
            rows, cols = np.nonzero(fresh)
            found = np.full(nodes.shape, -np.inf, np.float32)
            found[rows, cols] = visit(active[rows], nodes[rows, cols])
            keep = max(1, int(fresh.sum(axis=1).max(initial=0)))  # fresh nodes to the front, the rest cut off
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :keep]
            merge(active, np.take_along_axis(nodes, order, 1), np.take_along_axis(found, order, 1))
        return ids, sims, np.concatenate(hits) if hits else np.zeros((0, 2), np.int64), seen

    def walk(self, queries: np.ndarray, hits: np.ndarray, seen: np.ndarray, at_least: float) -> np.ndarray:
        """More (query, node) of at least that similarity: neighbours of what was found, then theirs, as long as they are nearly as similar.

        Links are followed both ways, as pruning may leave a node without any that lead to it. The work is
        linear in what is found, where a wider beam would begin anew. ``seen`` is kept up to date.
        """
        near, more, todo = self.near[0], [], [hits]
        sources, places = np.nonzero(near >= 0)
        targets = near[sources, places]
        sources = sources[np.argsort(targets, kind="stable")]
        ends = np.concatenate(([0], np.cumsum(np.bincount(targets, minlength=len(self.x)))))
        while todo:
            pairs = todo.pop()
            if len(pairs) > WALK:
                todo += np.array_split(pairs, -(-len(pairs) // WALK))
                continue
            nodes = near[pairs[:, 1]]
            rows = np.broadcast_to(pairs[:, :1], nodes.shape)
            rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
            sizes = ends[pairs[:, 1] + 1] - ends[pairs[:, 1]]
            back = np.arange(sizes.sum()) + np.repeat(ends[pairs[:, 1]] - np.cumsum(sizes) + sizes, sizes)
            rows, nodes = np.concatenate((rows, np.repeat(pairs[:, 0], sizes))), np.concatenate((nodes, sources[back]))
            fresh = ~seen[rows, nodes]
            code = np.unique(rows[fresh].astype(np.int64) * len(self.x) + nodes[fresh])
            rows, nodes = code // len(self.x), code % len(self.x)
            seen[rows, nodes] = True
            sims = np.einsum("nd,nd->n", self.x[nodes], queries[rows])
            found = np.column_stack((rows, nodes))
            more.append(found[sims >= at_least])
            if (on := sims >= at_least - STRAY).any():
                todo.append(found[on])
        return np.concatenate([hits, *more])

    def descend(self, queries: np.ndarray, to: int, width: int = 8) -> np.ndarray:
        """Seeds for level ``to``, from the entry point down."""
        seeds = np.full((len(queries), 1), self.entry, np.int32)
        for level in range(self.top, to, -1):
            seeds = self.beam(queries, width, level, seeds)[0]
        return seeds

    # -- building -------------------------------------------------------------------------

    def _spread(self, owners: np.ndarray, nodes: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates, best first, those nearer to the owner than to any chosen before; then the best of the rest."""
        chosen = np.zeros(nodes.shape, bool)
        vectors = self.x[np.maximum(nodes, 0)]
        pair = np.matmul(vectors, vectors.transpose(0, 2, 1))
        valid = np.isfinite(sims)
        for k in range(nodes.shape[1]):
            blocked = (np.where(chosen, pair[:, k], -np.inf).max(axis=1) > sims[:, k]) | (chosen.sum(axis=1) >= most)
            chosen[:, k] = valid[:, k] & ~blocked
        rest = valid & ~chosen
        room = most - chosen.sum(axis=1)
        chosen |= rest & (np.cumsum(rest, axis=1) <= room[:, None])
        return chosen

    def _link(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        """Add b to the neighbours of a, pruning rows that run over."""
        near, used, room = self.near[level], self.used[level], self.shape.room
        while len(a):
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            first = np.searchsorted(a, a)
            place = used[a] + np.arange(len(a)) - first
            fits = place < room
            near[a[fits], place[fits]] = b[fits]
            np.add.at(used, a[fits], 1)
            a, b = a[~fits], b[~fits]
            full = np.unique(a)
            if len(full):
                nodes = near[full]
                sims = np.einsum("nkd,nd->nk", self.x[nodes], self.x[full])
                order = np.argsort(-sims, axis=1, kind="stable")
                nodes, sims = np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)
                keep = self._spread(full, nodes, sims, self.shape.links)
                order = np.argsort(~keep, axis=1, kind="stable")
                nodes = np.take_along_axis(nodes, order, 1)
                used[full] = keep.sum(axis=1)
                nodes[np.arange(room) >= used[full][:, None]] = -1
                near[full] = nodes

    def add(self, batch: np.ndarray, inside: np.ndarray) -> None:
        """Insert nodes; ``inside`` are those inserted before."""
        queries = self.x[batch]
        mates = queries @ queries.T
        np.fill_diagonal(mates, -np.inf)
        seeds = np.full((len(batch), 1), self.entry if len(inside) else -1, np.int32)
        for level in range(self.top, -1, -1):
            if len(inside):
                ids, sims, _, _ = self.beam(queries, self.shape.build_beam, level, seeds)
                seeds = ids[:, :8]
            else:
                ids, sims = np.full((len(batch), 1), -1, np.int32), np.full((len(batch), 1), -np.inf, np.float32)
            on = np.flatnonzero(self.levels[batch] >= level)
            if not len(on):
                continue
            own = mates[np.ix_(on, on)]
            order = np.argsort(-own, axis=1, kind="stable")[:, : self.shape.links]
            nodes = np.concatenate((ids[on], batch[on][order].astype(np.int32)), axis=1)
            found = np.concatenate((sims[on], np.take_along_axis(own, order, 1)), axis=1)
            order = np.argsort(-found, axis=1, kind="stable")[:, : self.shape.build_beam]
            nodes, found = np.take_along_axis(nodes, order, 1), np.take_along_axis(found, order, 1)
            rows, cols = np.nonzero(self._spread(batch[on], nodes, found, self.shape.links))
            a, b = batch[on][rows], nodes[rows, cols].astype(np.int64)
            pairs = np.unique(np.concatenate((np.column_stack((a, b)), np.column_stack((b, a)))), axis=0)
            self._link(level, pairs[:, 0], pairs[:, 1])

    # -- storage --------------------------------------------------------------------------

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, levels=self.levels, near=np.stack(self.near) if self.near else np.zeros(0))
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes, shape: Shape) -> Graph:
        with np.load(io.BytesIO(data)) as f:
            graph = cls.__new__(cls)
            graph.x, graph.levels, graph.near, graph.shape = f["x"], f["levels"], list(f["near"]), shape
            graph.top, graph.entry = int(graph.levels.max(initial=0)), int(np.argmax(graph.levels))
            return graph


def build(vectors: np.ndarray, ids: np.ndarray, shape: Shape = Shape()) -> Graph:
    """The graph of unit vectors. Levels and the order of insertion come from the ids, so a rerun gives the same graph."""
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    uniform = ((mixed >> np.uint64(11)).astype(float) + 1) / 2.0**53
    levels = np.floor(-np.log(uniform) / np.log(shape.links)).astype(np.int32)
    graph = Graph(vectors, levels, shape)
    order = np.argsort(mixed, kind="stable")
    order = np.concatenate(([graph.entry], order[order != graph.entry])) if len(order) else order
    at = 0
    while at < len(order):
        size = min(256, max(64, at // 2))
        graph.add(order[at : at + size], order[:at])
        at += size
    return graph


def search(graph: Graph, queries: np.ndarray, cosine: float) -> np.ndarray:
    """(query, node) pairs of about ``cosine`` or more, single precision. Queries are unit vectors."""
    shape, n = graph.shape, len(graph.x)
    low, single = cosine - SLACK, queries.astype(np.float32)

    def exhaustive(rows: np.ndarray) -> np.ndarray:
        a, b = np.nonzero(single[rows] @ graph.x.T >= low)
        return np.column_stack((rows[a], b))

    every, width = np.arange(n_queries := len(single)), shape.beam
    while n_queries and width * 4 <= n:  # a wider beam reads the shard anyway
        _, _, hits, seen = graph.beam(single, width, 0, graph.descend(single, 0), low)
        hits = graph.walk(single, hits, seen, low)
        counts = np.bincount(hits[:, 0], minlength=n_queries)
        # The audit takes the queries with most links and others evenly.
        half = max(1, shape.audit // 2)
        audit = np.unique(np.concatenate((np.argsort(-counts, kind="stable")[:half], np.linspace(0, n_queries - 1, half).astype(int))))
        true = exhaustive(audit)
        if len(true) - counts[audit].sum() <= (1 - shape.recall) * len(true):
            return hits
        width *= 2
    return exhaustive(every)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that can link."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").alias("label"), v.alias("v"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
        .where(finite)
        .where(F.exists("v", lambda x: x != 0))
    )


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_numpy()).astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


FOUND = "kind string, a bigint, b bigint"


def links(nodes: DataFrame, cosine: float = COSINE, shape: Shape = Shape(), shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """From (id, label, v, n): rows ('count', id, linked vectors) per query and shard, and ('link', id, id) that join components."""
    keyed = nodes.withColumn("dim", F.size("v"))
    sizes = keyed.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    dealt = keyed.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x, ids = _unit(pdf["v"]), pdf["id"].to_numpy()
        graph = build(x.astype(np.float32), ids, shape)
        return pd.DataFrame(
            {
                "label": pdf["label"].iloc[:1], "dim": pdf["dim"].iloc[:1], "shard": pdf["shard"].iloc[:1], "size": [len(ids)],
                "ids": [ids.tobytes()], "counts": [pdf["n"].to_numpy().tobytes()], "x": [x.tobytes()], "graph": [graph.pack()],
            }
        )

    kind = nodes.schema["label"].dataType.simpleString()
    schema = f"label {kind}, dim int, shard int, size int, ids binary, counts binary, x binary, graph binary"
    graphs = stage(dealt.groupBy("label", "dim", "shard").applyInPandas(make, schema), "graphs")
    asking = graphs.select(
        "label", "dim", F.col("shard").alias("from"), F.col("ids").alias("q_ids"), F.col("x").alias("qx"),
        F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / block).cast("int"))).alias("block"),
    )
    # Blocks of queries meet each shard of their label, and no other: at most a shard and a block's vectors a row.
    width = F.col("dim") * 8
    asking = asking.select(
        "label", "dim", "from", "block",
        F.expr(f"substring(q_ids, block * {block} * 8 + 1, {block} * 8)").alias("q_ids"),
        F.substring("qx", F.col("block") * block * width + 1, width * block).alias("qx"),
    )
    meetings = asking.join(graphs.select("label", "dim", "shard", "ids", "counts", "x", "graph"), ["label", "dim"])
    spread = meetings.repartition("label", "dim", "from", "block", "shard")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                ids, counts = np.frombuffer(r.ids, np.int64), np.frombuffer(r.counts, np.int64)
                q_ids = np.frombuffer(r.q_ids, np.int64)
                x, qx = np.frombuffer(r.x).reshape(-1, r.dim), np.frombuffer(r.qx).reshape(-1, r.dim)
                pairs = search(Graph.unpack(r.graph, shape), qx, cosine)
                exact = [
                    p[np.einsum("nd,nd->n", qx[p[:, 0]], x[p[:, 1]]) >= cosine]
                    for p in np.array_split(pairs, max(1, len(pairs) // 65_536))
                ]
                pairs = np.concatenate(exact)
                pairs = pairs[q_ids[pairs[:, 0]] != ids[pairs[:, 1]]]
                linked = np.bincount(pairs[:, 0], weights=counts[pairs[:, 1]], minlength=len(q_ids)).astype(np.int64)
                names, place = np.unique(np.concatenate((q_ids, ids)), return_inverse=True)
                root = local_roots(len(names), place[pairs[:, 0]], place[len(q_ids) + pairs[:, 1]])
                joined = np.flatnonzero(root != np.arange(len(names)))
                yield pd.DataFrame({"kind": "count", "a": q_ids, "b": linked})
                yield pd.DataFrame({"kind": "link", "a": names[joined], "b": names[root[joined]]})

    return spread.mapInPandas(ask, FOUND)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shape: Shape = Shape(), shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = usable(vectors)
    nodes = stage(
        rows.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("n")), "vectors"
    )
    found = stage(links(nodes, cosine, shape, shard), "vector-links")
    counts = found.where("kind = 'count'").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("others"))
    roots = components(found.where("kind = 'link'").select("a", "b")).select(F.col("node").alias("id"), "root")
    named = nodes.join(counts, "id", "left").join(roots, "id", "left").select(
        "label", "v", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    per_row = rows.join(named, ["label", "v"]).select(F.col("vec_id").alias("__id"), "n_links", "component_id")
    per_id = per_row.groupBy("__id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    every = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    return every.join(per_id, F.col("vec_id") == F.col("__id"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
