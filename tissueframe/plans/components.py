"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.plans.lineage import drop_stored, store
from tissueframe.plans.skew import attach


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """Smallest node of the component of every node, as ``(id, component)``.

    ``edges`` has columns ``a`` and ``b``. In each round every node takes the
    smallest label around it and then follows that label's own label, which
    shortens long chains by half; rounds go on until nothing changes, so no
    component is cut short. Each round is one job whose labels are written to
    the shared folder. The label lookup is salted because the label of a large
    component is shared by a large part of the nodes. Meant for graphs of
    bounded degree, as the cell graphs of this package are.
    """
    links = edges.select("a", "b").where("a <> b")
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = store(links.distinct(), "links")
    labels = store(
        nodes.select(F.col(node).alias("id")).distinct().withColumn("component", F.col("id")), "components"
    )
    while True:
        around = (
            links.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(around, "id", "left").select(
            "id",
            F.col("component").alias("old"),
            F.least("component", F.coalesce("near", "component")).alias("component"),
        )
        own = labels.where(F.col("component") != F.col("id"))
        own = own.select(F.col("id").alias("component"), F.col("component").alias("jump"))
        jumped = attach(hooked, own, ["component"], "left", spread=["id"], salts=4)
        # Roots point to themselves and are not looked up.
        nearest = F.least("component", F.coalesce("jump", "component"))
        fresh = store(jumped.select("id", "old", nearest.alias("component")), "components")
        drop_stored(labels)
        labels = fresh.select("id", "component")
        labels._stored_at = fresh._stored_at
        if fresh.where(F.col("old") != F.col("component")).isEmpty():
            return labels
