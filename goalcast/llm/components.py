"""Connected components of an edge table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (long ids); root is the smallest node id
    that it reaches. Each round takes the smallest label among the neighbours (partial
    aggregation before the shuffle, so a hub costs one row a task) and then the label of that
    label; lineage is cut each round. Raises if ``max_rounds`` do not settle it."""
    both = cut_lineage(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                       .union(edges.select(F.col(b), F.col(a))).distinct(), "cc-edges")
    labels = cut_lineage(both.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.min("v"), F.first("u")).alias("root")), "cc-labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("best")))
        stepped = labels.join(near, "node").select("node", F.col("root").alias("old"),
                                                   F.least("root", "best").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        after = cut_lineage(stepped.join(jump, "mid").select("node", "old", F.col("far").alias("root")), "cc-labels")
        changed = after.where(F.col("old") != F.col("root")).limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError("connected components did not settle")


def joined_components(roots: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the components ``roots`` with more ``edges`` (a, b): only edges between
    different components count, and they are followed from root to root."""
    if roots is None:
        return connected_components(edges)
    for end in ("a", "b"):
        edges = (edges.join(roots.select(F.col("node").alias(end), F.col("root").alias("_r")), end, "left")
                 .withColumn(end, F.coalesce("_r", end)).drop("_r"))
    edges = cut_lineage(edges.where("a != b").distinct(), "cc-contracted")
    if not edges.limit(1).count():
        return roots
    sub = connected_components(edges)
    moved = roots.join(sub.select(F.col("node").alias("root"), F.col("root").alias("_r")), "root", "left") \
                 .select("node", F.coalesce("_r", "root").alias("root"))
    return cut_lineage(moved.unionByName(sub.join(roots.select("node"), "node", "left_anti").select("node", "root")), "cc-joined")
