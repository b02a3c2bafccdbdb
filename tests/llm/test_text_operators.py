"""Secret scan, quality rules, BPE and the classifier against brute force."""

import hashlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from stayline.llm import bpe, classifier, quality_rules, secrets
from stayline.llm.batches import Words, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_secrets(text):
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_secret_spans_equal_the_regexes():
    pieces = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "token", "=", ":", " ", '"', "'", "AKIA", "AK", "abcdef01",
              "0123456789abcdef", "zz", "é", "/", "ABCDEFGH12", "abcdefab" * 4, "\n", "tok", "pass"]
    rng, find = random.Random(5), secrets.scanner()
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [s for s in find.spans(text) if s[2] < 3] == plain_secrets(text), text


def test_added_secret_kinds_and_minimisation():
    find = secrets.scanner()
    text = "x ghp_" + "a1B" * 12 + " eyJabcdefghijk.eyJabcdefghijklmnop.abcdefghijklmn xoxb-123456789012 -----BEGIN RSA PRIVATE KEY-----"
    assert [secrets.RULES[k].kind for _, _, k in find.spans(text)] == ["github", "jwt", "slack", "pem"]
    assert find.n_states < find.states_built
    with pytest.raises(ValueError, match="empty"):
        secrets.Scanner((secrets.Rule("none", "", "a*"),))
    with pytest.raises(ValueError, match="stay one"):
        secrets.Scanner((secrets.Rule("gap", "", "a(?:bc)*"),))


def test_secret_query_digests(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in entry.queries()["op1_secret_scan"](spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = plain_secrets(d.text or "")
        joined = ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, b, k in base)
        r = got[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for *_, k in base) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def plain_rules(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeats, len(covered), failed


def plain_verdict(text, limits):
    """Whether the repetition rules, and whether all rules keep a text that passes the base rules."""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    shares = []
    for n, most in limits.grams:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        often = Counter(grams)
        inside = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + n)}
        shares.append(sum(len(words[j]) for j in inside) / chars <= most)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeats = sum(len(x) for i, x in enumerate(lines) if x in lines[:i])
    repetition = all(shares) and repeats / len(text) <= limits.line_chars
    return repetition, repetition and sum(c in "#*$%&|<>" for c in text) <= limits.symbols_per_word * len(words)


def test_verdicts_equal_a_plain_version(spark, docs_of):
    limits = quality_rules.Limits()
    rng = np.random.default_rng(3)

    def fresh(n):
        return " ".join(f"w{v}" for v in rng.integers(0, 10**9, n))

    made = {1: fresh(200), 2: fresh(60) + "\n" + fresh(10)}
    for i, n in enumerate((3, 5, 7, 10)):  # repeats of just one length, in a text of otherwise new words
        part = fresh(n)
        made[10 + i] = " ".join(f"{part} {fresh(1)}" for _ in range(7)) + " " + fresh(7 * n)
        made[20 + i] = f"{part} {fresh(80)} {part}"
    long = fresh(12)
    made[30] = f"{long}\n{fresh(50)}\n{long}\n{long}"  # lines
    made[31] = "\n".join(f"{fresh(8)}\na b" for _ in range(9))  # short lines that no run of words repeats
    made[32] = "x " * 3 + " ".join("long" * 20 + str(v) for v in range(9)) + " a b c " + fresh(45) + " a b c"
    made[33] = " ".join(w + "#" for w in fresh(80).split())  # symbols only
    docs = {d.doc_id: d.text or "" for d in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    docs = {**{k + 10**6: v for k, v in docs.items()}, **made}
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs_of(list(docs.items()))).collect()}
    want = {k: (False, False) if got[k].base_failed else plain_verdict(v, limits) for k, v in docs.items()}
    assert {k: r.kept for k, r in got.items()} == {k: v[1] for k, v in want.items()}
    alone = {k for k, v in want.items() if not got[k].base_failed and not v[0] and docs[k].count("#") == 0}
    assert len(alone) >= 3 and {1, 2, 20, 31} <= {k for k, v in want.items() if v[1]} and not want[33][1] and want[33][0]


def test_quality_rules_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in entry.queries()["op3_quality_rules"](spark, folder).collect()}
    for d in table(spark, folder, "documents").collect():
        r = got[d.doc_id]
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert mine == plain_rules(d.text or "")
        assert not (r.base_failed and r.kept)


def test_rules_keep_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    good = table(spark, folder, "labels").where("quality = 1")
    rows = entry.queries()["op3_quality_rules"](spark, folder).join(good, "doc_id").where("NOT base_failed")
    assert rows.where("kept").count() >= 0.99 * rows.count()


def test_repeats_survive_hash_collisions(monkeypatch):
    text = "a b c x a b c y d e f z d e f " * 2
    honest = Words([text, text]).repeated(3)
    monkeypatch.setattr("stayline.llm.batches._mix", lambda x: np.zeros(len(x), np.uint64))
    assert np.array_equal(Words([text, text]).repeated(3), honest)


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_stitched_chunks_equal_the_library(vocabulary):
    coder, rng = vocabulary.codec, random.Random(3)
    pieces = ["word", " ", "  ", "\n", "é", "日本", "😀", "'ll", "'", "123", "!!", "a" * 300, " " * 250, "x y z", "\t", "%$"]
    for k in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(60, 300)))
        chunk, overlap = rng.choice([150, 200, 400]), rng.choice([65, 74])
        parts = [(a, b, *bpe._encode_chunk(text[a:b], a, coder)) for a, b in bpe.chunk_spans(len(text), chunk, overlap)]
        assert bpe.stitch(parts, len(text), coder).tolist() == coder.encoding.encode_ordinary(text), k


@pytest.mark.parametrize("unit", ["a", " ", "7", "é"])
def test_one_long_run_is_split_a_bounded_number_of_times(vocabulary, monkeypatch, unit):
    coder, split = vocabulary.codec, []
    text = "before " + unit * 400_000 + " after"
    parts = [(a, b, *bpe._encode_chunk(text[a:b], a, coder)) for a, b in bpe.chunk_spans(len(text), 4096, 512)]
    whole = coder.encoding.encode_ordinary(text)
    plain = coder.boundaries
    monkeypatch.setattr(coder, "boundaries", lambda t: split.append(len(t)) or plain(t))
    assert bpe.stitch(parts, len(text), coder).tolist() == whole
    assert sum(split) <= 4 * len(text)


def test_chunked_documents_and_decoding(spark, docs_of, vocabulary):
    texts = ["", "short text", "long words and " * 400, "a" * 5000, " " * 3000 + "x", "日本語 " * 900, "long words and " * 400]
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(1, "short text"), (2, texts[2]), (None, texts[2]), (9, None)])
    encoded = bpe.encode(docs, vocabulary, chunk=1000, overlap=100)
    rows = bpe.decode(encoded, vocabulary).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.raw)) for r in rows) == sorted(
        (d.doc_id is None, d.doc_id or 0, (d.text or "").encode()) for d in docs.collect()
    )
    for r in rows:
        assert list(r.ids) == vocabulary.codec.encoding.encode_ordinary(bytes(r.raw).decode())


def test_a_worker_holds_only_what_it_uses(docs_of, vocabulary):
    """Executors hold several workers: one that decodes makes no tokenizer, and none loads pandas."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    ids = vocabulary.codec.encode("short text")
    assert coder.decode(ids) == b"short text" and "encoding" not in vars(coder)
    loaded = subprocess.run(
        [sys.executable, "-c", "import sys, stayline.llm.bpe; print('pandas' in sys.modules)"], capture_output=True, text=True, cwd=Path(__file__).parents[2]
    )
    assert loaded.stdout.strip() == "False", loaded.stderr
    plan = bpe.encode(docs_of([(1, "long words and " * 4000)]), vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3 and "InPandas" not in plan


def test_bpe_query_digests(spark, vocabulary):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in entry.queries()["op4_byte_bpe"](spark, folder).collect()}
    for d in table(spark, folder, "documents").collect():
        ids = vocabulary.codec.encoding.encode_ordinary(d.text or "")
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scored = entry.queries()["op6_quality_classifier"](spark, folder).join(table(spark, folder, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    held = [r for r in scored if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = classifier.fit_model(x[:3000], y[:3000])
    assert (0, 1) in model.pairs and np.mean((model.score(x[3000:]) > 0.5) == y[3000:]) > 0.9


def test_classifier_with_odd_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (None, 1, 0), (4, None, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    model = classifier.train(odd_docs, labels)  # one usable id, so one class
    assert classifier.score(odd_docs, model).count() == odd_docs.count()
    assert classifier.score(no_docs, classifier.train(no_docs, labels)).count() == 0
    kept = classifier.keep_good(odd_docs, classifier.Model(5.0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_odd_rows(spark, odd_docs, no_docs, vocabulary):
    n = odd_docs.count()
    for apply in (
        lambda d: secrets.digest(secrets.find_secrets(d)),
        quality_rules.apply_rules,
        lambda d: bpe.digest(bpe.encode(d, vocabulary), vocabulary),
    ):
        rows = apply(odd_docs).collect()
        assert len(rows) == n and sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd_docs.collect())
        assert apply(no_docs).count() == 0
