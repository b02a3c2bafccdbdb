"""Connected components of a link table, as joins and aggregates over staged label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stayline.session import stage


def components(links: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Each round gives a node the smallest label among its neighbours and then the label of
    that label, so the number of rounds grows with the logarithm of a component's width.
    Labels are written to the shared scratch folder each round, which cuts the lineage;
    nothing but the number of changed labels reaches the driver. A node with very many
    links is combined on the map side or split by the skew join.
    """
    pairs = links.select("a", "b").where("a <> b")
    both = stage(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    for _ in range(most_rounds):
        offered = (
            both.join(labels, F.col("a") == F.col("node"))
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("root").alias("offer"))
        )
        nearer = labels.join(offered, "node").select("node", "root", F.least("root", "offer").alias("to"))
        further = labels.select(F.col("node").alias("to"), F.col("root").alias("beyond"))
        moved = nearer.join(further, "to").select("node", F.least("to", "beyond").alias("next"), "root")
        moved = stage(moved.select("node", F.col("next").alias("root"), (F.col("next") < F.col("root")).alias("changed")), "labels")
        labels = moved.select("node", "root")
        if moved.where("changed").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {most_rounds} rounds")
