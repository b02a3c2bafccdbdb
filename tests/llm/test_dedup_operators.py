"""SimHash, line dedup, license scan and embedding near-dedup against brute force."""

import random

import duckdb
import numpy as np
import pytest
import xxhash

from stayline.llm import hnsw, licenses, lines, queries, simhash
from stayline.llm.components import components


def plain_components(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 300)] + [(400, 399), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 300)} | {399: 399, 400: 399}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_fingerprint(text):
    words = [w for w in text.encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_simhash(rows):
    prints = [plain_fingerprint(t or "") for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = plain_components(len(rows), pairs)
    least = {}
    for (doc, _), r in zip(rows, roots):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted((str(d), f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots))


def test_simhash_equals_brute_force(spark, docs_of):
    rng = random.Random(2)
    rows = []
    for base in range(30):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.choice([2, 4, 60, 400]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 500)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (None, rows[0][1]), (903, rows[0][1].upper())]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == plain_simhash(rows)


@pytest.mark.parametrize("code", [simhash.Covering(), simhash.Covering(segments=4), simhash.Covering(segments=3, parity=3)])
def test_close_fingerprints_always_share_an_anchor(code):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] ^= np.uint64(1 << int(bit))
    sets = []
    for prints in (x, y):
        keys, owners = simhash.anchors(prints, code)
        sets.append({p: set(keys[owners == p].tolist()) for p in prints.tolist()})
    assert all(sets[0][a] & sets[1][b] for a, b in zip(x.tolist(), y.tolist()))


def test_split_anchors_lose_no_link(spark):
    rng = np.random.default_rng(6)
    center = rng.integers(0, 2**63, dtype=np.uint64)
    prints = {int(center)}
    while len(prints) < 700:  # a dense ball and far points
        p = int(center) if len(prints) < 500 else int(rng.integers(0, 2**63))
        for bit in rng.choice(64, 5, replace=False):
            p ^= 1 << int(bit)
        prints.add(p)
    ids = np.array(sorted(prints), np.uint64)
    grid = np.bitwise_count(ids[:, None] ^ ids[None]) <= 4
    want = simhash.local_roots(len(ids), *np.nonzero(grid))
    nodes = spark.createDataFrame([(int(x),) for x in ids.view(np.int64)], "fp bigint")
    place = {v: i for i, v in enumerate(ids.view(np.int64).tolist())}
    for block in (64, 4096):
        found = simhash.links(nodes, block=block).collect()
        a, b = (np.array([place[getattr(r, c)] for r in found], int) for c in "ab")
        assert np.array_equal(simhash.local_roots(len(ids), a, b), want)


def test_keep_one_of_each_group(docs_of, odd_docs, no_docs):
    text = " ".join(f"word{i}" for i in range(300))
    docs = docs_of([(5, text), (3, text), (3, text), (9, text + " more"), (20, "else entirely, with other words in it"), (None, text)])
    assert sorted((str(r.doc_id)) for r in simhash.keep_one(docs).collect()) == ["20", "3", "None"]
    assert simhash.keep_one(odd_docs).columns == odd_docs.columns
    assert {r.doc_id for r in simhash.keep_one(odd_docs).collect()} == {None, 1, 4, 5, 6, 8}
    assert simhash.keep_one(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def same_as_oracle(df, name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame.toArrow())
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want.fetchall()))


def test_line_dedup_equals_sql(spark, docs_of):
    rng = random.Random(8)
    pool = [f"line {i}" for i in range(40)] + [""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(150)]
    run = [f"shared line {i}" for i in range(24)]
    rows += [(200 + i, "\n".join([f"own {i}", *run, f"end {i}"])) for i in range(40)] + [(300, None), (301, ""), (302, "\n\n")]
    got = lines.cut_repeats(docs_of(rows)).selectExpr("doc_id", "text", "__n_lines AS n_lines", "__n_removed AS n_removed")
    same_as_oracle(got, "op9_line_dedup", documents=docs_of(rows))
    assert got.where("doc_id BETWEEN 201 AND 239 AND n_removed >= 2").count() == 39  # shifts do not hide the shared run


def test_line_dedup_of_odd_rows(odd_docs, no_docs):
    got = lines.cut_repeats(odd_docs)
    assert got.columns == [*odd_docs.columns, "__n_lines", "__n_removed"] and got.count() == odd_docs.count()
    assert got.where("__n_removed > 0").count() == 0  # no two different ids share two lines
    assert lines.cut_repeats(no_docs).count() == 0


def test_licenses_equal_brute_force(docs_of, odd_docs, no_docs):
    rng = random.Random(9)
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    rows = []
    for i in range(60):
        words = [f"w{rng.randint(0, 99)}" for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, len(words))
        notice = rng.choice(notices).split()
        if i % 3 == 0:
            notice[rng.randrange(len(notice))] = "otherwise"
        rows.append((i, " ".join(words[:at] + notice + words[at:])))
    rows += [(100, None), (101, ""), (None, notices[0]), (5, notices[0].upper())]
    same_as_oracle(licenses.find_licenses(docs_of(rows)), "op8_license_scan", documents=docs_of(rows))
    assert licenses.find_licenses(no_docs).count() == 0 and licenses.find_licenses(odd_docs).count() == 0


def test_versions_and_siblings_are_told_apart(docs_of):
    gnu = "This work is licensed under the GNU {} General Public License, version {}."
    free = "under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or later"
    texts = {
        gnu.format("", "2"): {"GPL-2.0"}, gnu.format("", "3"): {"GPL-3.0"}, gnu.format("", "4"): set(),
        gnu.format("Lesser", "2.1"): {"LGPL-2.1"}, gnu.format("Lesser", "3"): {"LGPL-3.0"}, gnu.format("Lesser", "2"): set(),
        gnu.format("Affero", "3"): {"AGPL-3.0"}, gnu.format("Library", "2"): set(),
        free.format("", "2"): {"GPL-2.0"}, free.format("", "3"): {"GPL-3.0"}, free.format("Lesser ", "2.1"): {"LGPL-2.1"},
        free.format("Lesser ", "3"): {"LGPL-3.0"}, free.format("Affero ", "3"): {"AGPL-3.0"},
        "Licensed under the Apache License, Version 1.1.": set(), "Licensed under CC BY-NC-SA 4.0.": set(), "Licensed under CC BY-SA 3.0.": set(),
    }
    found = licenses.find_licenses(docs_of(list(enumerate(texts)))).collect()
    for i, (text, wanted) in enumerate(texts.items()):
        assert {r.license for r in found if r.doc_id == i} == wanted, text
    alone = [(f"{name}/{k}", text) for name, notices in licenses.TEMPLATES.items() for k, text in enumerate(notices)]
    found = licenses.find_licenses(docs_of([(i, text) for i, (_, text) in enumerate(alone)])).collect()
    assert {r.doc_id: r.license for r in found} == {i: name.split("/")[0] for i, (name, _) in enumerate(alone)} and len(found) == len(alone)


def test_license_plan_is_native(docs_of):
    for df in (licenses.find_licenses(docs_of([(1, "x")])), lines.cut_repeats(docs_of([(1, "x")]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_embeddings_equal_sql(spark):
    rng = np.random.default_rng(3)
    rows = []
    for label in range(3):
        for _ in range(12):
            center = rng.normal(size=8)
            for _ in range(rng.integers(1, 9)):
                rows.append((len(rows), [float(v) for v in center + rng.normal(size=8) * 0.08], label))
    rows += [(500 + i, rows[0][1], 0) for i in range(5)]  # equal vectors
    rows += [(600, None, 0), (601, [0.0] * 8, 0), (602, rows[0][1], None), (603, [float("nan")] * 8, 0), (604, [None] + [1.0] * 7, 0),
             (605, [1.0] * 7, 0), (606, [], 0), (607, [float("inf")] * 8, 0)]
    df = spark.createDataFrame(rows, VECTORS)
    for shard in (16_384, 20):  # one graph a label, and several
        same_as_oracle(hnsw.near_duplicates(df, shard=shard), "op10_hnsw_dedup", embeddings=df)


def test_null_ids_and_no_vectors(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1)], VECTORS)
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df.selectExpr("*", "'x' AS id", "1 AS n")).collect())
    assert got == [("1", 1, 1, True), ("2", 1, 1, False), ("2", 1, 1, False), ("None", 0, None, False)]
    assert hnsw.near_duplicates(df.limit(0)).count() == 0


def test_graph_search_finds_links_with_narrow_beams():
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(300, 32))
    x = np.repeat(centers, 8, axis=0) + rng.normal(size=(2400, 32)) * 0.1
    x = np.concatenate((x, centers[0] + rng.normal(size=(600, 32)) * 0.05))  # and one large group
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.unpack(hnsw.build(x.astype(np.float32), np.arange(len(x))).pack(), hnsw.Shape())
    pairs = hnsw.search(graph, x, 0.93)
    found = np.zeros((len(x), len(x)), bool)
    found[pairs[:, 0], pairs[:, 1]] = True
    true = x @ x.T >= 0.93
    assert (found & true).sum() >= 0.98 * true.sum()
    assert (found & true)[2400:].sum() == true[2400:].sum()  # the large group is walked through whole
