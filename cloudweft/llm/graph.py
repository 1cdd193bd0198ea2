"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudweft.llm.common import discard, tables, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); label is the smallest node that can be reached.

    A round takes each node's smallest label among its neighbours, and then that label's own label. Rounds go on until
    nothing changes; each round's labels are a written table, so lineage does not grow.
    """
    mark = tables()
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(near, labels.node == near.a, "left").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(best.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label")), "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.drop("old")
        discard(links.sparkSession, mark, new, *([both] if changed else []))
        if not changed:
            return labels
