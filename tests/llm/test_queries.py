"""The registered queries against their oracles, and the pipeline against its stages written plainly."""

import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stayline.llm import classifier, mixing, queries
from stayline.llm.batches import Words, table
from tests.llm.test_dedup_operators import plain_components, plain_fingerprint
from tests.llm.test_passages import plain_passages
from tests.llm.test_similar import plain_set, similar
from tools.compare import compare, oracle_connection

FOLDER = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in entry.queries() if n == "pipeline" or re.match(r"op\d+_", n)]
    assert {n.split("_")[0] for n in names} == {"pipeline", *(f"op{i}" for i in range(1, 14))} and len(names) == 14
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_oracles(spark, folder, name):
    assert compare(spark, oracle_connection(folder), folder, name) is None


def plain_chunks(rows):
    """Lines of repeated chunks, by (id, line), by the oracle's rules, read one text after another."""
    import hashlib

    seen, gone = set(), set()
    for doc, text in sorted(rows):
        chunk, before = [], 0
        lines = text.split("\n")
        for i, line in enumerate(lines):
            value = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
            chunk.append(line)
            if (before * 1_000_003 + value) % 2_147_483_647 % 3 == 0 or i == len(lines) - 1:
                if len(chunk) > 1 and tuple(chunk) in seen:
                    gone |= {(doc, k) for k in range(i - len(chunk) + 1, i + 1)}
                if len(chunk) > 1:
                    seen.add(tuple(chunk))
                chunk = []
            before = value
    return gone


def plain_line_dedup(rows):
    """Texts less their repeated chunks, long lines and passages."""
    gone = plain_chunks(rows) | plain_passages(rows)
    return {d: "\n".join(x for i, x in enumerate(text.split("\n")) if (d, i) not in gone) for d, text in rows}


def plain_near_dedup(texts):
    """The smallest id of each group of texts within 4 bits or of a 5-word similarity of 0.8."""
    ids = sorted(texts)
    sets, prints = [plain_set(texts[d]) for d in ids], [plain_fingerprint(texts[d]) for d in ids]
    pairs = [(i, j) for i in range(len(ids)) for j in range(i)]
    linked = [(i, j) for i, j in pairs if (prints[i] ^ prints[j]).bit_count() <= 4 or similar(sets[i], sets[j])]
    return {ids[r] for r in plain_components(len(ids), linked)}


def test_pipeline_equals_plain_stages(spark):
    docs = {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}
    model = classifier.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    scores = model.score(classifier.features(Words([d.text or "" for d in docs.values()])))
    texts = plain_line_dedup([(d, r.text) for (d, r), s in zip(docs.items(), scores) if s >= 0.3])
    texts = {d: texts[d] for d in plain_near_dedup(texts)}
    tokens = Counter()
    for d, text in texts.items():
        tokens[docs[d].source] += max(1, len(re.findall(r"[^\x20\x09-\x0D]+", text)))
    mix = corpus_pipeline.MIX
    wanted = mixing.quotas(tokens, mixing.weights(tokens, mixing.exponent_for(tokens, mix)), mix.budget)

    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(texts)  # every kept document is read once at least
    reads = Counter(r.doc_id for r in got)
    for source, n in wanted.items():
        own = [d for d in texts if docs[d].source == source]
        assert {reads[d] for d in own} <= {int(n // tokens[source]), int(n // tokens[source]) + 1}
        spent = sum(reads[d] * max(1, len(re.findall(r"[^\x20\x09-\x0D]+", texts[d]))) for d in own)
        largest = max(len(texts[d].split()) for d in own)
        assert n - largest - 1 <= spent <= n + 1
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, no_docs, tmp_path):
    labels = table(spark, FOLDER, "labels")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert i == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
            out.collect()


def test_crc_marks_held_out_rows(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", classifier.held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
