"""Connected components of a links table, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, comp)`` for every node that has a link; ``comp`` is the least
    node of its component. Links may repeat, run either way or join a node to itself; a null end
    makes no link. An empty table gives an empty result.

    Each round hooks every component onto the least neighbouring one and then follows those
    parents to their roots, so the number of rounds grows with the logarithm of the largest
    component. All state is in written tables; nothing but a count reaches the driver."""
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.min("a")).alias("comp")), "components")
    while True:
        parent = labels.select(F.col("node").alias("a"), F.col("comp").alias("la"))
        ends = (links.join(parent, "a")
                .join(parent.select(F.col("a").alias("b"), F.col("la").alias("lb")), "b"))
        hooks = (ends.where("la <> lb")
                 .groupBy(F.greatest("la", "lb").alias("root")).agg(F.min(F.least("la", "lb")).alias("up")))
        hooks = materialize(hooks, "hooks")
        if hooks.isEmpty():
            return labels
        while True:  # pointer jumping: a root that is itself hooked takes its parent's parent
            far = hooks.select(F.col("root").alias("up"), F.col("up").alias("further"))
            if hooks.join(far, "up", "left_semi").isEmpty():
                break
            hooks = materialize(hooks.join(far, "up", "left").select("root", F.coalesce("further", "up").alias("up")), "hooks")
        labels = materialize(labels.join(hooks.withColumnRenamed("root", "comp"), "comp", "left")
                             .select("node", F.coalesce("up", "comp").alias("comp")), "components")
