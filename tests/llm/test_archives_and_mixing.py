"""WARC archives and temperature mixing."""

import base64
import hashlib
import math

import pytest
import xxhash

from stayline.llm import mixing, warc
from stayline.session import scratch_path

PAGES = "page_id bigint, url string, html string, shard string"  # the last name clashes


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://example.com/{i}", f"<p>page {i}</p>" * (i % 7 + 1), "x") for i in range(200)]
    rows += [(300 + i, None, "<p>copied</p>", "x") for i in range(90)]
    rows += [(500, "http://a\r\nInjected: yes", None, "x"), (501, None, "", "x"), (502, "u", "ünï 😀", "x"), (None, "u", "<p>copied</p>", "x"),
             (310, None, "<p>copied</p>", "x"), (300, None, "<p>copied</p>", "x"), (600, "u", "long " * 400_000, "x")]
    return spark.createDataFrame(rows, PAGES)


def test_archives_round_trip(spark, pages):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages, folder, shard_rows=40, roll_bytes=4000).collect()
    assert len({r.shard for r in manifest}) > 4 and max(r.roll for r in manifest) > 0
    assert all(r.bytes <= 4000 or r.records == 1 for r in manifest)
    got = warc.read_archives(spark, folder).collect()
    firsts = {}
    for p in pages.collect():
        if p.page_id is not None:
            firsts[p.html or ""] = min(p.page_id, firsts.get(p.html or "", p.page_id))
    want = []
    for p in pages.collect():
        raw = (p.html or "").encode()
        first = firsts[p.html or ""] if p.page_id is not None else None
        revisit = p.page_id is not None and first < p.page_id
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((p.page_id, len(raw), digest, "revisit" if revisit else "response", first if revisit else None, None if revisit else raw))
    mine = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(map(repr, mine)) == sorted(map(repr, want))
    assert not any("\n" in r.url for r in got)


def test_archives_are_deterministic_and_ignore_strays(spark, pages):
    hashes = []
    for parts in (1, 5):
        folder = scratch_path(spark, "warc-test")
        warc.write_archives(pages.repartition(parts), folder, shard_rows=64)
        hashes.append(sorted((r.file, r.sha256) for r in warc.read_manifest(spark, folder).collect()))
    assert hashes[0] == hashes[1]
    filesystem, path = warc._open(folder)
    with filesystem.open_output_stream(f"{path}/shard-00099-00000.warc.gz", compression=None) as f:
        f.write(b"left behind by a lost task")
    assert warc.read_archives(spark, folder).count() == pages.count()
    empty = scratch_path(spark, "warc-test")
    assert warc.write_archives(pages.limit(0), empty).count() == 0 and warc.read_archives(spark, empty).count() == 0


def test_shards_follow_the_ids(spark):
    ids = [*range(20_000), 2**60, -(2**62) - 5, 2**62 + 9, 2**63 - 1, -(2**63)]
    far = spark.createDataFrame([(i, "u", f"<p>{i % 9000}</p>") for i in ids], "page_id bigint, url string, html string")
    none = spark.range(5000).selectExpr("CAST(NULL AS BIGINT) AS page_id", "concat('n', id) AS url", "'same' AS html")
    hot = spark.range(5000).selectExpr("7L AS page_id", "'u' AS url", "concat('hot', id) AS html")
    pages = far.unionByName(none).unionByName(hot)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages, folder).collect()
    sizes = {r.shard: 0 for r in manifest}
    for r in manifest:
        sizes[r.shard] += r.records
    assert sum(sizes.values()) == len(ids) + 10_000 and max(sizes.values()) == warc.SHARD_ROWS and len(sizes) == 15
    got = {r.page_id: r.refers_to for r in warc.read_archives(spark, folder, payloads=False).where("page_id IS NOT NULL AND page_id <> 7").collect()}
    firsts = {}
    for i in sorted(ids):
        firsts.setdefault(i % 9000, i)
    assert got == {i: None if firsts[i % 9000] == i else firsts[i % 9000] for i in ids if i != 7}


def test_folder_names():
    assert warc._uri("s3a://lake/a/b") == warc._uri("s3://lake/a/b") == "s3://lake/a/b"
    assert warc._uri("file:/tmp/a") == warc._uri("file:///tmp/a") == "file:///tmp/a" and warc._uri("hdfs://n/a") == "hdfs://n/a"


def test_cut_archives_are_refused():
    import io

    whole = warc.zlib.compressobj(6, warc.zlib.DEFLATED, 31)
    data = whole.compress(warc.record(1, "u", b"text", None, warc.DATE)) + whole.flush()
    assert [warc.parse(m)[0] for m in warc.members(io.BytesIO(data + data))] == [1, 1]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(io.BytesIO(data + data[:-9])))


def test_exponents_meet_their_targets():
    tokens = {"a": 900_000, "b": 50_000, "c": 50_000, "empty": 0}
    x = mixing.exponent_for(tokens, mixing.Mix(most_epochs=None, entropy=0.8))
    assert math.isclose(mixing.entropy(mixing.weights(tokens, x)), 0.8, abs_tol=1e-9)
    x = mixing.exponent_for(tokens, mixing.Mix(most_epochs=3.0))
    shares = mixing.weights(tokens, x)
    wanted = mixing.quotas(tokens, shares, None)
    assert math.isclose(wanted["a"], 900_000, rel_tol=1e-9) and math.isclose(wanted["b"], 150_000, rel_tol=1e-6)
    assert math.isclose(sum(shares.values()), 1) and shares["empty"] == 0
    assert mixing.exponent_for({}, mixing.Mix()) == 0.0 and mixing.weights({}, 1.0) == {}


def plain_schedule(rows, mix):
    """Every read, by a walk over all blocks and documents of each source in order."""

    def long_hash(seed, *values):
        h = 42
        for v in (seed, *values):
            h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else (v & (2**64 - 1)).to_bytes(8, "little"), h)
        return h - 2**64 if h >= 2**63 else h

    sources = {}
    for doc, text, source in rows:
        key = "-" if source is None else f"s{source}"
        order = long_hash(mix.seed, key, *([] if doc is None else [str(doc)]))
        sources.setdefault(key, []).append((order, doc, max(1, len((text or "").split()))))
    tokens = {s: sum(t for *_, t in docs) for s, docs in sources.items()}
    wanted = mixing.quotas(tokens, mixing.weights(tokens, mixing.exponent_for(tokens, mix)), mix.budget)
    out = []
    for source, docs in sources.items():
        blocks = {}
        n = max(1, -(-tokens[source] // mix.block_tokens))
        for row in docs:
            blocks.setdefault(long_hash(mix.seed + 1, row[0]) % n, []).append(row)
        whole, rest = divmod(round(wanted[source]), tokens[source])
        out += [(source, doc, e) for _, doc, _ in docs for e in range(whole)]
        for b in sorted(blocks, key=lambda b: (long_hash(mix.seed + 2, source, b, whole), b)):
            size = sum(t for *_, t in blocks[b])
            if size <= rest:
                out += [(source, doc, whole) for _, doc, _ in blocks[b]]
                rest -= size
                continue
            for _, doc, t in sorted(blocks[b], key=lambda r: r[0]):
                if t > rest:
                    break
                out.append((source, doc, whole))
                rest -= t
            break
    return sorted(map(repr, out))


@pytest.mark.parametrize("mix", [mixing.Mix(block_tokens=60), mixing.Mix(entropy=0.97, most_epochs=None, budget=700, block_tokens=40)])
def test_schedule_equals_a_walk(docs_of, mix):
    rows = [(i, "w " * (i % 13), "big" if i % 3 else ("mid" if i % 2 else None)) for i in range(240)] + [(999, None, "tiny")]
    got = mixing.schedule(docs_of(rows), mix).collect()
    key = {None: "-"}
    assert sorted(repr((key.get(r.source, f"s{r.source}"), r.doc_id, r.epoch)) for r in got) == plain_schedule(rows, mix)


def test_mixing_odd_rows(odd_docs, no_docs):
    got = mixing.mixed(odd_docs)
    assert got.columns == odd_docs.columns
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in odd_docs.collect()}
    assert mixing.mixed(no_docs).count() == 0
