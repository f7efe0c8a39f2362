"""Connected components of an edge table, by rounds of shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.scale import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of `edges`: the least node of its component.

    Each round every node takes the least label among itself and its neighbours, then the label of that
    label, which halves the way to the root.  Minima are combined before their shuffle, so a node with very many
    neighbours costs no task more than its share.  Rounds end when nothing changes; each is written to the
    shared folder, so a lost executor repeats one round at most.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = written(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
                     .select("node", F.least("node", "least").alias("label"), F.lit(True).alias("moved")))
    while not labels.where("moved").isEmpty():
        known = labels.select(F.col("node").alias("v"), F.col("label").alias("seen"))
        heard = both.join(known, "v").groupBy(F.col("u").alias("node")).agg(F.min("seen").alias("heard"))
        lower = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = written(lower.join(jump, "label").select(
            "node", F.least("label", "further").alias("label"), (F.least("label", "further") < F.col("old")).alias("moved")))
    return labels.select("node", "label")
