"""Connected components by contraction, in DataFrame joins (the method of ``llm.components``, which nothing outside ``llm`` imports)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _roots(parent: DataFrame) -> DataFrame:
    """(node, root) from (node, root) pointers that never rise: pointer jumping."""
    while True:
        far = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
        parent = written(parent.join(far, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")), "cc-parent")
        if not parent.where("moved").limit(1).count():
            return parent.select("node", "root")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node; root is the component's least node.

    Each round every node points to its least neighbour (or itself), the
    pointers are followed to their ends, and links are redrawn between those
    ends, so the nodes left at least halve per component and round.  Joins
    hold one row per node on one side; a hot end is left to AQE's skew join.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    found = None
    while edges.limit(1).count():
        parent = edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root"))
        roots = _roots(written(parent, "cc-parent"))
        if found is None:
            found = roots
        else:
            step = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = written(found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "cc-found")
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(left, "a").join(right, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
    if found is None:
        kind = links.schema[a].dataType.simpleString()
        return links.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return found
