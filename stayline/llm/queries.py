"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm import align, bpe, classifier, hnsw, licenses, lines, mixing, quality_rules, secrets, simhash, toxicity, trie, warc
from stayline.llm.batches import table
from stayline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANKS = "byte_bpe_50k.tiktoken"
MERGES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


@query()
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, folder, "documents")))


# Base 32 from the hexadecimal digest: every five bits from two neighbouring digits.
@query(
    """
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
      array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (((strpos('0123456789abcdef', substr(h, CAST(i * 5 // 4 + 1 AS INT), 1)) - 1) * 16
          + strpos('0123456789abcdef', substr(h, CAST(i * 5 // 4 + 2 AS INT), 1)) - 1) // (CASE i * 5 % 4 WHEN 0 THEN 8
            WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END)) % 32 AS INT), 1)), '') AS payload_digest,
      CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN page_id > first THEN first END AS refers_to
    FROM (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first
          FROM (SELECT page_id, coalesce(html, '') AS html FROM pages) p) q
    """
)
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.digest(warc.read_archives(spark, archives, payloads=False))


@query()
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, folder, "documents"))


@query()
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digest(bpe.encode(table(spark, folder, "documents"), vocabulary), vocabulary)


@query()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return classifier.score(docs, classifier.train(docs, table(spark, folder, "labels")))


@query()
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query(
    """
    WITH l AS (
      SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
    ), v AS (SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS v FROM l
    ), b AS (
      SELECT *, (coalesce(lag(v) OVER w, 0) * 1000003 + v) % 2147483647 % 3 = 0 AS cut, count(*) OVER (PARTITION BY doc_id) AS n
      FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY i)
    ), c AS (
      SELECT *, coalesce(sum(CASE WHEN cut THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM b
    ), chunks AS (
      SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS bytes, count(*) AS size FROM c GROUP BY doc_id, place
    ), gone AS (
      SELECT doc_id, place FROM (SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, place) AS nth
        FROM chunks WHERE size > 1) q WHERE nth > 1
    ), kept AS (
      SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM c ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
    )
    SELECT d.doc_id, CASE WHEN d.text IS NULL OR d.doc_id IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text,
      CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS BIGINT) AS n_lines,
      CAST(CASE WHEN d.text IS NULL OR d.doc_id IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) - coalesce(k.n, 0) END AS BIGINT)
        AS n_removed
    FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
    """
)
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = lines.cut_repeats(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "text", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"))


@query(licenses.oracle_sql())
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(table(spark, folder, "documents"))


@query()
def op5_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.schedule(table(spark, folder, "documents"))


# Brute force: every pair of a label, then components by the smallest id each vector reaches.
@query(
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), p AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.93
    ), r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b
    ), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a
    ), n AS (SELECT a, count(DISTINCT b) AS n FROM p GROUP BY a)
    SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
      coalesce(coalesce(c.component_id, e.vec_id) = e.vec_id, FALSE) AS kept
    FROM embeddings e LEFT JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
    """
)
def op10_hnsw_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


# Brute force over whole prefixes as lists; CRC-32 bit by bit.
@query(
    """
    WITH t AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos, {'r': role, 't': text} AS x
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) q
    ), heads AS (
      SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
        list_transform(range(1, 1 + length(CAST(conv_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda z, k: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384) ELSE z >> 1 END, xor(c, b)),
        CAST(4294967295 AS BIGINT))) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t) q
    ), r AS (
      SELECT h.conv_id, t.pos, t.x FROM heads h JOIN t ON t.conv_id = h.base AND t.pos < h.h
      UNION ALL SELECT h.conv_id, t.pos, t.x FROM heads h JOIN t ON t.conv_id = h.conv_id AND t.pos >= h.h
    ), c AS (
      SELECT h.conv_id, coalesce(s, []) AS s FROM heads h LEFT JOIN (SELECT conv_id, list(x ORDER BY pos) AS s FROM r GROUP BY conv_id) q USING (conv_id)
    ), p AS (
      SELECT conv_id, s, d, s[1:d] AS k FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM c) q
    ), n AS (
      SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
        (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].t) END AS saved
      FROM p GROUP BY d, k
    ), m AS (
      SELECT n.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM n w WHERE w.d = n.d + 1 AND w.k[1:n.d] = n.k) AS n_children
      FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.k[1:n.d - 1]
    )
    SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, any_value(a.parent_conv_id) AS parent_conv_id, CAST(any_value(a.n_convs) AS BIGINT) AS n_convs,
      CAST(any_value(a.n_children) AS BIGINT) AS n_children, CAST(count(*) FILTER (b.n_children = 0) AS BIGINT) AS n_leaves,
      CAST(sum(b.saved) AS BIGINT) AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
    FROM m a JOIN m b ON b.d >= a.d AND b.k[1:a.d] = a.k GROUP BY a.conv_id, a.d
    """
)
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(table(spark, folder, "conversations"))


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    shared = align.Shared(spark, path(MERGES), path(PIECES), public_tokenizers.PATTERN)
    return align.aligned_documents(table(spark, folder, "documents"), shared)
