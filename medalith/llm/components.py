"""Connected components of a link table, by joins only.

Every round points each node at the smallest node seen next to it and at that node's own pointer, so the distance to
the smallest node of a component about halves per round. Rounds are written to the shared work folder; no link ever
reaches the driver, which reads one number per round. Hot nodes are combined before the shuffle (``min``), and the
joins can be split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm.frames import stored


def connected_components(spark: SparkSession, links: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Self links and repeated links are allowed, links with a null end are ignored, an empty table gives an empty one.
    """
    clean = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    clean = clean.where("a is not null and b is not null")
    both = clean.unionByName(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(spark, both, f"{label}-edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component"))
    labels = stored(spark, labels, f"{label}-0")
    turn = 0
    while True:
        turn += 1
        seen = edges.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b")
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("c").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("next"))
        moved = stepped.join(jump, "c").select("node", "old", F.least("c", "next").alias("component"))
        moved = stored(spark, moved, f"{label}-{turn}")
        labels = moved.select("node", "component")
        if not moved.where("old <> component").limit(1).count():
            return labels
