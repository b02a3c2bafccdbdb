"""Line dedup of the pipeline: passages and long lines that stand earlier go whole."""

import random
from collections import Counter

import corpus_pipeline
from stayline.llm import lines


def plain_passages(rows, long=50):
    """Lines that cut_passages removes beyond repeated chunks, by (id, line), read one text after another."""
    seen, gone = set(), set()
    for doc, text in sorted(rows):
        own = text.split("\n")
        again = []
        for i, line in enumerate(own):
            if len(line.split()) > long:
                if line in seen:
                    gone.add((doc, i))
                seen.add(line)
            pair = tuple(own[i : i + 2])
            if len(pair) == 2:
                again.append(pair in seen)
                seen.add(pair)
        i = 0
        while i < len(again):
            j = i
            while j < len(again) and again[j]:
                j += 1
            if j > i and sum(len(x.split()) for x in own[i : j + 1]) > long:
                gone |= {(doc, k) for k in range(i, j + 1)}
            i = j + 1
    return gone


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))


def test_planted_passages_go_whole(docs_of):
    rng = random.Random(3)
    rows, planted = [], []
    for n in range(60):  # passages of 2 to 6 lines in an early text and amid other lines of a later one
        passage = [words(rng, rng.randint(26, 40)) for _ in range(2 + n % 5)]
        rows.append((n, "\n".join([words(rng, 5), *passage, words(rng, 7)])))
        around = [words(rng, 6) for _ in range(4)]
        rows.append((1000 + n, "\n".join(around[:2] + passage + around[2:])))
        planted.append((1000 + n, "\n".join(around)))
    rows += [(500, words(rng, 3) + "\n" + (line := words(rng, 60))), (1500, f"before\n{line}\nafter"), (1501, line)]
    got = {r.doc_id: r.text for r in lines.cut_passages(docs_of(rows)).collect()}
    assert all(got[d] == text for d, text in planted)
    assert got[1500] == "before\nafter" and got[1501] == ""
    assert all(got[d] == text for d, text in rows if d < 1000)  # the first stays


def test_passages_equal_plain_version(docs_of):
    rng = random.Random(5)
    pool = [words(rng, rng.choice([1, 12, 30, 55])) for _ in range(25)] + [""]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(120)]
    df = docs_of(rows)
    chunks = {r.doc_id: r.text for r in lines.cut_repeats(df).collect()}
    got = {r.doc_id: r.text for r in lines.cut_passages(df).collect()}
    gone = plain_passages(rows)
    for doc, text in rows:
        own = text.split("\n")
        beyond = [x for i, x in enumerate(own) if (doc, i) not in gone]
        assert len(got[doc]) <= min(len("\n".join(beyond)), len(chunks[doc]))
        if chunks[doc] == text:
            assert got[doc] == "\n".join(beyond)
    assert set(pool) >= (left := {x for t in got.values() for x in t.split("\n")}) and left == {x for _, t in rows for x in t.split("\n")} | {""}


def test_passages_of_odd_rows(spark, odd_docs, no_docs, docs_of):
    got = lines.cut_passages(odd_docs)
    assert got.columns == odd_docs.columns and got.exceptAll(odd_docs).count() == 0 and got.count() == odd_docs.count()
    assert lines.cut_passages(no_docs).count() == 0
    text = "\n".join(f"line {i} " + "x " * 30 for i in range(4))
    rows = [(None, text), (1, text), (1, text), (1, "other"), (2, text), (3, None)]
    left = [(str(r.doc_id), r.text, r.n_chars) for r in corpus_pipeline.line_dedup(spark, docs_of(rows), "").collect()]
    n = len(text)
    assert Counter(left) == Counter([("None", text, n), ("1", text, n), ("1", text, n), ("1", "other", 5), ("2", "", 0), ("3", None, None)])
