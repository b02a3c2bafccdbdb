"""Token alignment, conversation trie and toxicity models against plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
from stayline.llm import align, toxicity, trie
from stayline.llm.batches import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shared(spark):
    path = public_tokenizers.path
    return align.Shared(spark, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_groups(libraries, text):
    """Groups of (A ids, B ids) by walking bytes, straight from the libraries."""
    if not text:
        return []
    a, b = libraries
    char = {v: k for k, v in enumerate_bytes().items()}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(char[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        hexed = re.fullmatch("<0x(..)>", piece)
        bytes_b.append(bytes.fromhex(hexed[1]) if hexed else piece.replace("▁", " ").encode())
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends = [set(np.cumsum([len(t) for t in x]).tolist()) for x in (bytes_a, bytes_b)]
    common = ends[0] & ends[1]
    groups = [[[], []] for _ in common]
    for side, (ids, raw) in enumerate(((ids_a, bytes_a), (ids_b, bytes_b))):
        at = end = 0
        for i, token in zip(ids, raw):
            groups[at][side].append(i)
            end += len(token)
            at += end in common
    return groups


def enumerate_bytes():
    """Byte to character of a byte-level vocabulary."""
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b], n = chr(256 + n), n + 1
    return out


def plain_alignment(libraries, rows):
    each = [(doc, plain_groups(libraries, text)) for doc, text in rows]
    held = Counter(p for _, groups in each for p in {(x, y) for a, b in groups for x in a for y in b})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc, groups in each:
        links = [(x, y) for a, b in groups for x in a for y in b]
        joined = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[p] == top[p[0]] for p in links),
             sum(held[p] for p in links), hashlib.sha256(joined.encode()).hexdigest() if groups else "")
        )
    return out


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_alignment_query_equals_plain_version(spark, libraries):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    got = entry.queries()["op13_token_alignment"](spark, FOLDER).collect()
    assert sorted_rows(got) == sorted_rows(plain_alignment(libraries, docs))


def test_alignment_of_odd_texts(spark, docs_of, shared, libraries):
    rng = random.Random(8)
    pieces = ["word", " ", "  ", "\n", "é", "日本", "😀", "'ll", "'", "123", "!!", "x y", "\t", "▁", "<|endoftext|>", "<s>", "<0x41>", "\u0085", "\xa0", "\x00", "ﬁ", "٣"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(300)] + ["", None, " ", "   a", "a" * 3000, " " * 2000, "same", "same"]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    docs = docs_of(rows).repartition(3)
    for chunk in (200, align.CHUNK):
        got = align.aligned_documents(docs, shared, chunk).collect()
        assert sorted_rows(got) == sorted_rows(plain_alignment(libraries, rows))


def test_fast_and_described_tokens_agree(shared, libraries):
    coder, (a, _) = shared.tokenizers, libraries
    assert coder._fast is not None
    for c in range(0x250):  # every character for which ranks stand in, in several surroundings
        for text in (f" a{chr(c)}b", f" {chr(c)} {chr(c)}{chr(c)}x", f" 1{chr(c)}2 !{chr(c)}?", f"  {chr(c)}  \n{chr(c)}'s"):
            assert coder.a_ids([text])[0] == a.encode(text, add_special_tokens=False).ids, (c, text)


def test_windows_are_remembered(shared, monkeypatch):
    coder = shared.tokenizers
    a, b = map(np.array, coder.both("one two one two one, two"))
    ends = align.cut(coder, a, b)
    assert len(ends[0]) >= 5 and ends[0][-1] == len(a) and ends[1][-1] == len(b)
    windows = align.Windows(coder)
    first = align.numbered(windows, a, b, *ends).tolist()
    assert len(windows) == len(set(first)) < len(first)
    assert align.numbered(windows, a, b, *ends).tolist() == first and len(windows) == len(set(first))
    # Windows whose hashes are equal are still told apart, and long groups are listed by their different ids.
    monkeypatch.setattr(align, "_mix", lambda x: np.zeros(len(x), np.uint64))
    monkeypatch.setattr(align, "LONG", 1)
    other = align.Windows(coder)
    again = align.numbered(other, a, b, *ends).tolist()
    assert [other.texts[i] for i in again] == [windows.texts[i] for i in first]
    of = lambda w, found: {(int(w.pairs()[p]), int(n)) for _, p, n in zip(*w.linked(np.array(found), np.zeros(len(found), np.int64)))}
    assert of(other, again) == of(windows, first)


def plain_trie(rows):
    """Nodes from whole prefixes of rebuilt conversations."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, t in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(math.fmod(c, 5))
        whole[c] = own.get(base, [])[:h] + t[h:]
    members = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ended = ",".join(map(str, sorted(c for c in ids if len(whole[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], sum(not children[q] for q in below), saved,
                    hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_whole_prefixes(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), -3, -7, 10**15]:
        for t in range(rng.choice([1, 1, 2, 3, 9, 14])):
            rows.append((c, None if rng.random() < 0.03 else t, rng.choice(["user", None, "bot"]) if t else "user", rng.choice(["a", "bé", "", None]) if t else "hello"))
    rows += [(None, 0, "user", "x"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, CONVERSATIONS).selectExpr("*", "'clash' AS key", "'clash' AS pos", "'clash' AS open", "1 AS _bucket")
    got = sorted((tuple(r) for r in trie.conversation_trie(df).select(*trie.NODE).collect()), key=lambda r: r[:2])
    # Ties of equal turns are ordered by the digest, so equal turns with other texts are left out of the comparison.
    ties = Counter((c, t) for c, t, _, _ in rows)
    if max(ties.values()) <= 3:
        assert got == plain_trie([r for r in rows])


def test_trie_of_conversations_without_turns_and_of_none(spark):
    # Conversation 1 takes up to eight turns of conversation 0, which does not exist, and has too few of its own.
    short = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = spark.createDataFrame([(short, 0, "user", "gone")], CONVERSATIONS)
    (root,) = trie.conversation_trie(rows).collect()
    assert tuple(root) == (short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())
    assert trie.conversation_trie(rows.limit(0)).count() == 0


def test_range_minima_reach_what_scans_reach():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 4, 200)
    found = trie.RangeMinimum(values)
    start, floor = rng.integers(0, 200, 300), rng.integers(0, 5, 300)
    right, left = found.reach_right(start, floor), found.reach_left(start, floor)
    for s, f, r, l in zip(start, floor, right, left):
        end = s
        while end + 1 < 200 and values[end + 1] >= f:
            end += 1
        begin = s
        while begin >= 0 and values[begin] >= f:
            begin -= 1
        assert (r, l) == (end, begin)
    lo = np.minimum(start, start[::-1])
    hi = np.maximum(start, start[::-1])
    assert found.least(lo, hi).tolist() == [values[a : b + 1].min() for a, b in zip(lo, hi)]


def plain_words(text):
    return [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", text.lower()) if w]


def plain_differences(rows, texts, p):
    """The models' log-likelihood differences from counters over words, for ``rows`` of (text, toxic)."""
    count, docs, held = [Counter(), Counter()], [Counter(), Counter()], Counter()
    for text, toxic in rows:
        words = plain_words(text)
        pairs = list(zip(words, words[1:]))
        count[toxic].update(words + pairs)
        docs[toxic].update(set(words) | set(pairs))
        held.update(set(words))
    n = [sum(c for w, c in count[k].items() if isinstance(w, str)) for k in (0, 1)]
    kinds = [sum(isinstance(w, str) for w in count[k]) for k in (0, 1)]
    size = [sum(t == k for _, t in rows) for k in (0, 1)]

    def tells(x):
        seen = [docs[k][x] for k in (0, 1)]
        cells = [(seen[k], sum(seen) * size[k] / sum(size)) for k in (0, 1)]
        cells += [(size[k] - seen[k], (sum(size) - sum(seen)) * size[k] / sum(size)) for k in (0, 1)]
        return 2 * sum(a * math.log(a / e) for a, e in cells if a) >= p.evidence

    def alone(w, k):
        shared = held[w] / sum(held.values())
        if not tells(w):
            return shared
        return max(count[k][w] - p.discount, 0) / n[k] + min(p.discount, 1) * kinds[k] / n[k] * shared

    pairs = [x for x in count[1] if isinstance(x, tuple) and count[1][x] >= p.least_pair and tells(x)]
    led = defaultdict(lambda: [0.0, 0.0])
    for x in pairs:
        for k in (0, 1):
            led[x[0]][k] += max(count[k][x] - p.discount, 0)

    def after(u, w, k):
        rest = 1 - led[u][k] / count[k][u] if u in led and count[k][u] else 1.0
        own = rest * alone(w, k)
        return own + (max(count[k][u, w] - p.discount, 0) / count[k][u] if (u, w) in known and count[k][u] else 0.0)

    known = set(pairs)
    out = []
    for text in texts:
        words = [w for w in plain_words(text)]
        total = 0.0
        for i, w in enumerate(words):
            if not held[w]:
                rest_of_pair = 0.0
            elif i and held[words[i - 1]]:
                rest_of_pair = math.log(after(words[i - 1], w, 1) / after(words[i - 1], w, 0))
            else:
                rest_of_pair = math.log(alone(w, 1) / alone(w, 0))
            total += rest_of_pair
            if i and not held[w] and words[i - 1] in led:  # an unknown word has one chance in both classes, but its context's rest differs
                u = words[i - 1]
                total += math.log((1 - led[u][1] / count[1][u]) / ((1 - led[u][0] / count[0][u]) if count[0][u] else 1))
        if words and words[-1] in led:  # the end of a text is one more event
            u = words[-1]
            total += math.log((1 - led[u][1] / count[1][u]) / ((1 - led[u][0] / count[0][u]) if count[0][u] else 1))
        out.append((len(words), total))
    return out


def test_toxic_differences_equal_plain_models(spark):
    rng = random.Random(4)
    mild, bad = ["good", "day", "the", "sea", "été", "a1"], ["vile", "you vile", "vile rat", "the rat"]
    rows = []
    for i in range(120):
        toxic = int(i % 4 == 0)
        rows.append((" ".join(rng.choice(mild) if rng.random() < 0.8 or not toxic else rng.choice(bad) for _ in range(rng.randint(1, 30))), toxic))
    p = toxicity.Fit(evidence=3.0)
    frame = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    values = toxicity.expression_values(toxicity.count_expressions(frame, p), sum(t for _, t in rows), sum(1 - t for _, t in rows), p)
    texts = [t for t, _ in rows] + ["", "unknown words", "you unknown vile, RAT! The sea"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.difference) for r in toxicity.differences(docs, values).collect()}
    for i, (n, want) in enumerate(plain_differences(rows, texts, p)):
        assert got[i][0] == n and got[i][1] == pytest.approx(want, abs=1e-9), texts[i]
    assert values.where("abs(value) > 0.5").count() > 3


def test_kneser_ney_backs_off_by_contexts_of_all_pairs(spark):
    """Distinct words before a word, pairs of ordinary rows and pairs seen once all count, and enter the values."""
    rng = random.Random(6)
    rows = [("calm sea " * rng.randint(0, 2) + " ".join(rng.choice(["good", "day", "sea", "vile", "rat"]) for _ in range(rng.randint(0, 6))), 0) for _ in range(60)]
    rows += [("you vile rat " + " ".join(rng.choice(["good", "rat", "vile"]) for _ in range(rng.randint(0, 6))), 1) for _ in range(25)]
    p = toxicity.Fit(evidence=3.0, contexts=True)
    counts = toxicity.count_expressions(spark.createDataFrame(rows, "text string, toxic int").repartition(3), p)
    n, d, before = [Counter(), Counter()], [Counter(), Counter()], defaultdict(set)
    for text, toxic in rows:
        words = plain_words(text)
        pairs = list(zip(words, words[1:]))
        n[toxic].update(words + pairs)
        d[toxic].update(set(words) | set(pairs))
        for u, w in zip([None, *words], words):
            before[w].add(u)
    name = lambda w: int(np.array([xxhash.xxh64_intdigest(w)], np.uint64).view(np.int64)[0])
    key = lambda x: name(x) if isinstance(x, str) else int(toxicity.pair_key(*(np.array([name(w)]) for w in x))[0])
    kept = {x for x in n[0] | n[1] if isinstance(x, str) or max(n[0][x], n[1][x]) >= p.least_pair}
    got = {r.key: r for r in counts.collect()}
    assert {key(x) for x in kept} == set(got)
    for x in kept:
        r = got[key(x)]
        assert (r.n_t, r.n_o, r.d_t, r.d_o) == (n[1][x], n[0][x], d[1][x], d[0][x])
        assert r.contexts == (len(before[x]) if isinstance(x, str) else None)
    assert any(not n[1][x] for x in kept if not isinstance(x, str))

    size, held = (60, 25), sum(map(len, before.values()))
    total, kinds = ([f(n[k][w] for w in before if n[k][w]) for k in (0, 1)] for f in (sum, lambda c: len(list(c))))

    def tells(x):
        cells = [(d[k][x], (d[0][x] + d[1][x]) * size[k] / 85) for k in (0, 1)]
        cells += [(size[k] - d[k][x], (85 - d[0][x] - d[1][x]) * size[k] / 85) for k in (0, 1)]
        return 2 * sum(a * math.log(a / e) for a, e in cells if a) >= p.evidence

    def alone(w, k):
        shared = len(before[w]) / held
        return max(n[k][w] - p.discount, 0) / total[k] + p.discount * kinds[k] / total[k] * shared if tells(w) else shared

    told = [x for x in kept if not isinstance(x, str) and tells(x)]
    led = [{u: sum(max(n[k][x] - p.discount, 0) for x in told if x[0] == u) for u, _ in told} for k in (0, 1)]
    rest = lambda u, k: 1 - led[k].get(u, 0) / n[k][u] if n[k][u] else 1.0
    want = {key(w): math.log(alone(w, 1) / alone(w, 0) * rest(w, 1) / rest(w, 0)) for w in before if tells(w) or w in led[0]}
    for u, w in told:
        part = [(max(n[k][u, w] - p.discount, 0) / n[k][u] if n[k][u] else 0.0) / (rest(u, k) * alone(w, k)) + 1 for k in (0, 1)]
        want[key((u, w))] = math.log(part[1] / part[0])
    assert {r.key: r.value for r in toxicity.expression_values(counts, 25, 60, p).collect()} == pytest.approx(want, abs=1e-9)
    assert any(want[key(x)] < 0 for x in told if not n[1][x])  # a pair that only ordinary rows hold


def test_pairs_with_equal_counts_and_second_word_stand_together():
    class Rows:
        """Keeps the function that counts."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            raise StopIteration

    rows, words = Rows(), random.Random(3).choices([f"w{i}" for i in range(90)], k=4000)
    with pytest.raises(StopIteration):
        toxicity.count_expressions(rows, toxicity.KNESER_NEY)
    texts = [" ".join(words[i : i + 40]) for i in range(0, 4000, 40)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": pa.array([i % 2 for i in range(len(texts))], pa.int32())})
    (found,) = rows.run(iter([batch]))
    alike = list(zip(*[found.column(c).to_pylist() for c in found.schema.names if c != "first"]))
    assert sum(a != b for a, b in zip(alike, alike[1:])) == len(set(alike)) - 1
    assert found.num_rows == len(set(zip(found.column("first").to_pylist(), found.column("second").to_pylist())))


def test_counting_holds_no_text_as_words_and_hands_on_small_batches(monkeypatch):
    class Rows:
        """Keeps the function that counts."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            raise StopIteration

    rows, words = Rows(), random.Random(4).choices([f"word{i}" for i in range(500)], k=100_000)
    texts = [" ".join(words[i : i + 1000]) for i in range(0, 100_000, 1000)]
    tracemalloc.start()
    tokens = toxicity.Tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(words)  # a bytes object a word takes more
    assert tokens.keys.view(np.uint64).tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    assert tokens.counts.tolist() == [1000] * 100 and tokens.text_of.tolist() == [i // 1000 for i in range(100_000)]

    monkeypatch.setattr(toxicity, "PIECE", 1000)
    with pytest.raises(StopIteration):
        toxicity.count_expressions(rows, toxicity.KNESER_NEY)
    batch = pa.RecordBatch.from_pydict({"text": texts, "toxic": pa.array([i % 2 for i in range(len(texts))], pa.int32())})
    found = list(rows.run(iter([batch])))
    assert {x.num_rows for x in found[:-1]} == {1000} and 0 < found[-1].num_rows <= 1000
    of_text = [["", *t.split()] for t in texts]
    want = Counter((i % 2, a, b) for i, t in enumerate(of_text) for a, b in zip(t, t[1:]))
    key = {w: xxhash.xxh64_intdigest(w) for w in set(words)} | {"": toxicity.START}
    got = {(r["first"] % 2**64, r["second"] % 2**64): (r["n_t"], r["n_o"]) for x in found for r in x.to_pylist()}
    assert got == {(key[a], key[b]): (want[1, a, b], want[0, a, b]) for _, a, b in want}


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    scored = entry.queries()["op11_toxicity"](spark, folder)
    rows = scored.join(table(spark, folder, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) > 0.9 and np.mean([r.predicted for r in clean]) < 0.02


def test_toxicity_with_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 1), (None, 1, 1), (4, None, None), (5, 7, 9), (7, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_toxicity(odd_docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd_docs.collect()) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert toxicity.score_toxicity(odd_docs, labels.limit(0)).where("score = 0.5").count() == odd_docs.count()
    empty = [r.score for r in got if r.doc_id in (1, 2)]
    assert empty[0] == empty[1]


def test_filter_never_misses(spark):
    keys = [int(x) for x in np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)]
    bits = toxicity.key_filter(spark.createDataFrame([(k,) for k in keys], "key bigint").repartition(4)).value
    assert toxicity.passes(bits, np.array(keys)).all()
    other = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    assert toxicity.passes(bits, other).mean() < 0.01


def test_alignment_odd_docs(spark, odd_docs, no_docs, shared):
    got = align.aligned_documents(odd_docs, shared).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd_docs.collect())
    assert align.aligned_documents(no_docs, shared).count() == 0
