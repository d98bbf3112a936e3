"""Connected components of an edge table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import drop, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the smallest node that can be reached. Only nodes with an edge appear.

    Minimum-label propagation along edges, then pointer jumping along labels, until nothing changes; labels are
    written to the shared folder each round. Aggregation combines before the shuffle, and a giant component or hub is hot only on the side of a join
    that adaptive execution may split. Nothing is collected but one count a round. Edges with a null end and from a node to
    itself are ignored, repeated ones count once, and an empty edge table gives an empty result.
    """
    links = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    links = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    n = links.count()  # from the files' footers
    label = stored(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "cc-labels", n)
    while True:
        near = links.join(label, links.b == label.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = label.join(near, "node").select("node", "component", F.least("component", "m").alias("m"))
        jump = label.select(F.col("node").alias("m"), F.col("component").alias("further"))
        nxt = stored(step.join(jump, "m").select("node", F.least("m", "further").alias("component"), (F.least("m", "further") < F.col("component")).alias("moved")), "cc-labels", n)
        drop(label)
        label = nxt.select("node", "component")
        label.stored_at = nxt.stored_at
        if not nxt.where("moved").limit(1).count():
            drop(links)
            return label
