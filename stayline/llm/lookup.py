"""Values of a large table for the keys that a chunk of rows needs, without broadcasting the table.

A chunk row holds many documents in a few arrays, and the distinct keys that they use. Keys
are joined to the table, and what is found goes back to the chunk. A key has one row per
chunk at most, however often documents hold it, so no key is hot; a chunk's answer is no
longer than its own keys. The join is a merge join at every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def looked_up(chunks: DataFrame, keys: str, table: DataFrame, values: list[str]) -> DataFrame:
    """The chunk rows with ``found``: (key, values...) of those ``keys`` that ``table`` (unique by ``key``) has."""
    wanted = chunks.select("chunk", F.explode(keys).alias("key"))
    found = wanted.join(table.select("key", *values).hint("merge"), "key").groupBy("chunk")
    return chunks.join(found.agg(F.collect_list(F.struct("key", *values)).alias("found")), "chunk", "left")
