"""Connected components of an edge table, by least labels.

Every round gives each node, and the node that is its present label, the least
label among its neighbours, then follows labels one step further; rounds
needed grow with the logarithm of a component's length in practice.  Each
round is written to the shared folder, and the one before deleted.  All groupings are sums of the min kind,
made before the shuffle, and joins are between written tables, which Spark can
split where a hub or a label has very many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; label: the component's least node.

    Null ends, loops and repeated edges are ignored; no edge gives no row.
    """
    ab = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna().filter("a <> b")
    both = stored(ab.union(ab.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        seen = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        near = labels.join(seen, "node")
        lower = (near.select("node", F.least("label", "low").alias("label"))
                 .union(near.filter("low < label").select(F.col("label").alias("node"),
                                                          F.col("low").alias("label")))
                 .groupBy("node").agg(F.min("label").alias("label")))
        lower = stored(lower, "labels")
        then = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = (lower.join(then, "label").select("node", "next")
               .join(labels, "node")
               .select("node", F.col("next").alias("label"),
                       (F.col("next") < F.col("label")).alias("moved")))
        new = stored(new, "labels")
        drop(edges.sparkSession, lower, labels)
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            drop(edges.sparkSession, both)
            return labels
