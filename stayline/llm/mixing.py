"""Mixing sources by temperature: weights from shares to a power, realised as block permutations.

A source's weight is its share of all tokens, raised to an exponent and normalised. An
exponent of 1 keeps the shares, 0 makes all sources equal. The exponent is bisected until
the weights have a wanted entropy, or until the most repeated source is read a given number
of times. A source's tokens are its weight times the budget; it is read in whole epochs
and, for the rest, a part of one. Documents are dealt into blocks by a hash of the id; each
epoch orders a source's blocks anew by a seeded hash, and the last one takes blocks in that
order while the budget lasts, then documents of one more block in hash order.

Without a budget the smallest one is taken that reads every source at least once, so no
document is left out and the smaller sources repeat.

Tokens are words (``[^\\x20\\x09-\\x0D]+``), at least one a document. Null and empty texts count
one. A null source is a source of its own, and a null id an id like any other. Rows that
repeat an id in a source share its hash and fare alike. Only sources' totals reach the
driver. Extra columns are carried along by :func:`mixed`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stayline.llm.columns import any_columns
from stayline.session import stage

MOST_BLOCKS = 65_536  # of a source; beyond it blocks grow
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Mix:
    """``entropy`` is a fraction of the largest possible one; give it or ``most_epochs``, or both.

    With both, the limit on epochs comes first.
    """

    entropy: float | None = None
    most_epochs: float | None = 2.0
    budget: int | None = None
    block_tokens: int = 1 << 18
    seed: int = 17


def weights(tokens: dict, exponent: float) -> dict:
    """Shares to the power of ``exponent``, normalised; a source without tokens has none."""
    top = max(tokens.values(), default=0)
    raised = {s: (t / top) ** exponent if t else 0.0 for s, t in tokens.items()}
    total = math.fsum(raised.values())
    return {s: r / total for s, r in raised.items()} if total else raised


def entropy(shares: dict) -> float:
    """As a fraction of that of equal weights; 1 for a single source."""
    positive = [w for w in shares.values() if w > 0]
    return -math.fsum(w * math.log(w) for w in positive) / math.log(len(positive)) if len(positive) > 1 else 1.0


def quotas(tokens: dict, shares: dict, budget: int | None) -> dict:
    """Tokens to read of each source; without a budget the least tokens that read each source whole."""
    total = budget if budget is not None else max((t / shares[s] for s, t in tokens.items() if t), default=0)
    return {s: shares[s] * total for s in tokens}


def _bisect(low: float, high: float, too_low) -> float:
    """Exponent at which ``too_low`` turns false."""
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if too_low(middle) else (low, middle)
    return high


def exponent_for(tokens: dict, mix: Mix) -> float:
    """Entropy falls and epochs get more even as the exponent rises to 1."""

    def epochs(exponent: float) -> float:
        wanted = quotas(tokens, weights(tokens, exponent), mix.budget)
        return max((wanted[s] / t for s, t in tokens.items() if t), default=0.0)

    chosen = []
    if mix.entropy is not None:
        chosen.append(_bisect(0.0, 16.0, lambda x: entropy(weights(tokens, x)) > mix.entropy))
    if mix.most_epochs is not None:
        limit = mix.most_epochs * (1 + 1e-12)
        chosen.append(0.0 if epochs(0.0) <= limit else _bisect(0.0, 1.0, lambda x: epochs(x) > limit))
    return max(chosen, default=1.0)


def _sized(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return docs.withColumn("__tokens", F.greatest(words, F.lit(1)).cast("bigint")).withColumn(
        "__source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-"))
    )


def _placed(rows: DataFrame, mix: Mix) -> DataFrame:
    """Place of a row: its block among the source's ``__blocks``, and its order in the block."""
    own = F.xxhash64(F.lit(mix.seed).cast("bigint"), "__source", F.col("doc_id").cast("string"))
    return rows.withColumn("__order", own).withColumn(
        "__block", F.pmod(F.xxhash64(F.lit(mix.seed + 1).cast("bigint"), "__order"), F.col("__blocks"))
    )


@dataclass
class Plan:
    exponent: float
    shares: dict
    sources: DataFrame
    blocks: DataFrame


def plan(docs: DataFrame, mix: Mix = Mix()) -> Plan:
    """Weights, and per block of each source how much of it is read.

    ``blocks``: __source, __block, __epochs (whole reads), __cut (in the last, partial epoch
    rows with an order up to it are read too).
    """
    spark = docs.sparkSession
    sized = stage(_sized(docs.select("doc_id", "source", "text")).select("doc_id", "__source", "__tokens"), "mix-sizes")
    # One row a source reaches the driver.
    tokens = {r["__source"]: int(r["n"]) for r in sized.groupBy("__source").agg(F.sum("__tokens").alias("n")).orderBy("__source").collect()}
    exponent = exponent_for(tokens, mix)
    shares = weights(tokens, exponent)
    wanted = {s: round(q) for s, q in quotas(tokens, shares, mix.budget).items()}
    names = list(tokens)
    sources = spark.createDataFrame(
        pa.table(
            {
                "__source": pa.array(names, pa.string()),
                "__blocks": pa.array([max(1, min(MOST_BLOCKS, -(-tokens[s] // mix.block_tokens))) for s in names], pa.int64()),
                "__epochs": pa.array([wanted[s] // tokens[s] for s in names], pa.int64()),
                "__rest": pa.array([wanted[s] % tokens[s] for s in names], pa.int64()),
            }
        )
    )
    placed = _placed(sized.join(sources, "__source"), mix)
    sums = placed.groupBy("__source", "__block", "__epochs", "__rest").agg(F.sum("__tokens").alias("__tokens"))
    order = F.xxhash64(F.lit(mix.seed + 2).cast("bigint"), "__source", "__block", "__epochs")
    ahead = Window.partitionBy("__source").orderBy("__key", "__block").rowsBetween(Window.unboundedPreceding, -1)
    ranked = stage(sums.withColumn("__key", order).withColumn("__before", F.coalesce(F.sum("__tokens").over(ahead), F.lit(0))), "mix-blocks")
    split = ranked.where("__before < __rest AND __before + __tokens > __rest").select("__source", "__block", (F.col("__rest") - F.col("__before")).alias("__left"))
    # The rows of one block a source: the only ones that are ordered one by one.
    inside = Window.partitionBy("__source", "__block").orderBy("__order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        placed.join(split, ["__source", "__block"])
        .withColumn("__sum", F.sum("__tokens").over(inside))
        .where("__sum <= __left")
        .groupBy("__source", "__block")
        .agg(F.max("__order").alias("__reached"))
    )
    cut = F.when(F.col("__before") + F.col("__tokens") <= F.col("__rest"), F.lit(LONG_MAX)).otherwise(F.coalesce("__reached", F.lit(LONG_MIN)))
    blocks = stage(ranked.join(cuts, ["__source", "__block"], "left").select("__source", "__block", "__epochs", cut.alias("__cut")), "mix-plan")
    return Plan(exponent, shares, sources.select("__source", "__blocks"), blocks)


def draws(docs: DataFrame, made: Plan, mix: Mix = Mix()) -> DataFrame:
    """The rows, once for each time they are read, with ``__epoch`` and the block's ``__turn`` in it.

    A source's sequence is its rows by epoch, turn, block and ``__order``.
    """
    placed = _placed(_sized(docs).join(made.sources, "__source"), mix)
    times = F.col("__epochs") + F.when(F.col("__order") <= F.col("__cut"), 1).otherwise(0)
    read = placed.join(made.blocks, ["__source", "__block"]).withColumn("__times", times).where("__times > 0")
    turn = F.xxhash64(F.lit(mix.seed + 2).cast("bigint"), "__source", "__block", "__epoch")
    return read.withColumn("__epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__times") - 1))).withColumn("__turn", turn)


@any_columns
def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents, with all their columns, as often as the mix reads them."""
    return draws(docs, plan(docs, mix), mix).select(*(F.col(f"`{c}`") for c in docs.columns))


def schedule(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, turn) of every read."""
    slim = docs.select("doc_id", "source", "text")
    return draws(slim, plan(slim, mix), mix).select(
        "doc_id", "source", F.col("__tokens").alias("n_tokens"), F.col("__epoch").alias("epoch"), F.col("__block").alias("block"),
        F.col("__turn").alias("turn"), F.col("__order").alias("place"),
    )
