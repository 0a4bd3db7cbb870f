"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlens.session import materialise


def components(links: DataFrame, alone: DataFrame | None = None) -> DataFrame:
    """(id, component) for the ends of ``links`` (a, b) and the ids of ``alone``: the smallest id reached.

    Each round a vertex takes the least label among its neighbours', then the label of that label, so paths
    shrink by half or better.  Rounds are written to the shared folder; the driver sees one count a round.  Joins are merges at
    any size: a broadcast would pass the labels through the driver, several times a round.
    """
    links = materialise(links.select("a", "b").where("a <> b").distinct(), "component-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min("b").alias("least"))
    labels = materialise(near.select(F.col("a").alias("id"), F.least("a", "least").alias("component")), "component-labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "component").hint("merge"), "b").select(F.col("a").alias("id"), "component")
        own = labels.select("id", "component", F.col("component").alias("was"))
        taken = own.unionByName(seen, allowMissingColumns=True).groupBy("id")
        taken = taken.agg(F.max("was").alias("was"), F.min("component").alias("lower"))
        # Two steps at once: the label's own label of the last round.
        jump = labels.select(F.col("id").alias("lower"), F.col("component").alias("beyond")).hint("merge")
        step = taken.join(jump, "lower", "left").select("id", "was", F.least("lower", "beyond").alias("component"))
        step = materialise(step, "component-labels")
        moved = step.where("component <> was").limit(1).count()
        labels = step.select("id", "component")
        if not moved:
            break
    if alone is not None:
        rest = alone.select("id").distinct().join(labels.hint("merge"), "id", "left_anti")
        labels = labels.unionByName(rest.select("id", F.col("id").alias("component")))
    return labels
