"""Connected components of an edge table, by min-label propagation with
pointer jumping.  Labels stay in tables; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(id, label)``: every node that has an edge, with
    the smallest node of its component.  Each round joins narrow tables on
    unique labels (a hub's edges are split by the skew join) and at least
    halves the longest way to a smallest node."""
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                            .where("a <> b").distinct(), "comp-edges")
    labels = materialise(both.groupBy(F.col("a").alias("id"))
                             .agg(F.least(F.first("a"), F.min("b")).alias("label")), "comp-labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("label").alias("l")), "b")
                    .groupBy(F.col("a").alias("id")).agg(F.min("l").alias("l")))
        step = labels.join(near, "id").select("id", F.col("label").alias("was"),
                                              F.least("label", "l").alias("label"))
        step = materialise(step, "comp-step")
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("l"))
        after = materialise(step.join(jump, "label", "left")
                                .select("id", "was", F.coalesce("l", "label").alias("label")), "comp-labels")
        labels = after.select("id", "label")
        if after.where("was <> label").isEmpty():
            return labels
