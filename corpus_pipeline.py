"""Corpus pipeline: classify, cut out repeated lines, drop near copies, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.llm import bpe, classifier, lines, mixing, simhash
from stayline.llm.batches import table
from stayline.llm.queries import RANKS
from stayline.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No source is cut: the largest is read once, smaller ones up to twice.
MIX = mixing.Mix(most_epochs=2.0)


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classifier.keep_good(docs, classifier.train(docs, table(spark, folder, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated chunks, long lines and passages go from the texts; ``n_chars`` follows the text."""
    cut = lines.cut_passages(docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return cut.select(*(size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, by SimHash or by 5-word similarity of 0.8, stays."""
    return simhash.keep_one_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the tempered weights read them, once at least."""
    return mixing.mixed(docs, MIX)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number and hash of the token ids of every text read, and hash of what they decode to."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.digest(bpe.encode(docs, vocabulary), vocabulary)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("temperature mixing", mix),
    ("byte-level BPE", encode),
]

ORACLE_SQL = None  # SQL can express neither the classifier nor the encoding; tests compare with a brute-force version


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared scratch folder and read again."""
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
