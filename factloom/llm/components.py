"""Connected components of an edge table by minimum labels with pointer jumping; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (node, component): the smallest node that can be reached.

    Loops and repeated edges change nothing; an empty table gives an empty table. Every round halves the distance to
    the smallest node (labels also jump to their label's label), and each round is cut off by a written table.
    """
    both = materialize(edges.select("u", "v").where("u <> v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")).where("u <> v")).distinct())
    labels = materialize(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("best"))
        better = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "best").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = materialize(better.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
