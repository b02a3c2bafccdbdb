"""Near-dedup of the pipeline: planted copies of 5-word Jaccard similarity of 0.8 or more go."""

import random

import numpy as np

from stayline.llm import simhash
from tests.llm.test_dedup_operators import plain_components, plain_fingerprint


def plain_set(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    return len(a | b) > 0 and 5 * len(a & b) >= 4 * len(a | b)


def corpus(rng):
    rows = []
    for _ in range(60):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([3, 60, 200, 600]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randint(0, 3)):
            copy = list(words)
            for _ in range(rng.randint(1, max(1, len(words) // 55))):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 5000)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_similar_copies_go(docs_of):
    rows = corpus(random.Random(4)) + [(900, None), (901, ""), (902, "one two"), (903, "ONE two")]
    sets, prints = [plain_set(t or "") for _, t in rows], [plain_fingerprint(t or "") for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)]
    alike = [(i, j) for i, j in pairs if similar(sets[i], sets[j])]
    close = [(i, j) for i, j in pairs if (prints[i] ^ prints[j]).bit_count() <= 4]
    far = [p for p in alike if p not in set(close)]
    assert len(far) > 20  # SimHash alone misses these
    roots = plain_components(len(rows), alike + close)
    got = {r.doc_id for r in simhash.keep_one_similar(docs_of(rows)).collect()}
    assert got == {rows[r][0] for r in roots}
    assert got < {r.doc_id for r in simhash.keep_one(docs_of(rows)).collect()}


def test_split_bands_lose_no_link(spark, docs_of):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        copy[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    docs = docs_of(rows)
    sketched = simhash.sketches(docs).cache()
    place = {fp: i for i, fp in enumerate(sorted({r.fp for r in sketched.collect()}))}
    for block in (7, 512):
        found = simhash.similar_links(docs, sketched, block=block).collect()
        assert set(plain_components(len(place), [(place[r.a], place[r.b]) for r in found])) == {0}


def test_pairs_connect_all_that_is_similar():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(80)]
    pairs = [(i, j) for i in range(80) for j in range(i) if 2 * len(s := np.intersect1d(sets[i], sets[j])) >= len(sets[i]) + len(sets[j]) - len(s)]
    assert plain_components(80, simhash._joined(sets, 0.5)) == plain_components(80, pairs)


def test_similar_of_odd_rows(odd_docs, no_docs):
    got = simhash.keep_one_similar(odd_docs)
    assert got.columns == odd_docs.columns and {r.doc_id for r in got.collect()} == {None, 1, 4, 5, 6, 8}
    assert simhash.keep_one_similar(no_docs).count() == 0
