"""Connected components of an edge table, distributed.

Hash-to-min with pointer jumping: every node keeps the least id it knows of; each round shuffles the edges once. The rounds
end when no label changes (their number grows with the logarithm of the longest chain, not with the data). Labels are written
to the shared folder each round, so lineage stays short and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.workspace import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): component is the least node id in it. Nodes without an edge are not listed."""
    both = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").union(edges.select(F.col(b), F.col(a)).filter(f"{a} <> {b}")).distinct(), "edges")
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("component")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        stepped = labels.join(near, labels["node"] == near["u"], "left").select("node", F.col("component").alias("before"), F.least("component", F.coalesce("near", "component")).alias("component"))
        # pointer jumping: the label of the label
        up = stepped.select(F.col("node").alias("at"), F.col("component").alias("above"))
        new = cut(stepped.join(up, stepped["component"] == up["at"], "left").select("node", "before", F.least("component", F.coalesce("above", "component")).alias("component")), "labels")
        changed = new.filter("component <> before").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
