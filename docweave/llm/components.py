"""Connected components of a graph of 64-bit nodes, by Spark joins.

Every node carries a label, at first itself. A round takes the least label of a node and its neighbours, lets the
tree a label stands for follow the least that any of its nodes has seen, and shortens paths by looking a label's own
label up. Rounds end when no label changes: about the logarithm of the longest path. Each round is settled as a table,
so lineage stays short and an executor's loss costs a re-read. Only counts come to the driver.

Joins are on nodes, whose number of edges the caller keeps small, or on labels, where one label may stand for very many
nodes: those are inner joins of two shuffled sides, which adaptive execution splits where a key is hot, and everything
grouped by label is combined before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): the smallest node that can be reached from it."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a")).where("node <> other").distinct()
    both = settle(both, "edges")
    labels = settle(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        other = labels.select(F.col("node").alias("other"), F.col("label").alias("seen"))
        near = both.join(other, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("to"))
        roots = hooked.groupBy("label").agg(F.min("to").alias("root"))
        moved = settle(hooked.join(roots, "label").select("node", "label", F.least("to", "root").alias("to")), "moved")
        jump = moved.select(F.col("node").alias("to"), F.col("to").alias("next"))
        after = settle(moved.join(jump, "to").select("node", F.col("label").alias("old"), F.least("to", "next").alias("label")), "labels")
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
