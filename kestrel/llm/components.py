"""Connected components of a link table, in rounds of DataFrame joins.

Every round hooks each node to its smallest neighbour, follows the hooks one
more step, and contracts the links to the hooked nodes, so the link table
shrinks geometrically; a star of any size disappears in one or two rounds.
Hooks are found by a map-side combined minimum, and the joins have written
tables on both sides, so Spark may split a hot node's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is
    the smallest node id in it."""
    both = lambda l: l.unionAll(l.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = materialize(links.select("a", "b").filter("a <> b"), "component-links")
    labels = None
    while not links.isEmpty():
        hooks = (both(links).groupBy("a").agg(F.min("b").alias("m"))
                 .select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
        hooks = materialize(hooks, "component-hooks")
        # A second step along the hooks; roots point at themselves.
        onward = hooks.select(F.col("node").alias("mid"), F.col("to").alias("end"))
        parents = materialize(hooks.join(onward, F.col("to") == F.col("mid"))
                              .select("node", F.col("end").alias("to")), "component-parents")
        if labels is None:
            labels = parents.select("node", F.col("to").alias("component"))
        else:
            step = parents.withColumnRenamed("node", "from")
            labels = materialize(
                labels.join(step, F.col("component") == F.col("from"), "left")
                .select("node", F.coalesce("to", "component").alias("component")), "component-labels")
        left = parents.select(F.col("node").alias("x"), F.col("to").alias("u"))
        right = parents.select(F.col("node").alias("y"), F.col("to").alias("v"))
        links = materialize(
            links.join(left, F.col("a") == F.col("x")).join(right, F.col("b") == F.col("y"))
            .filter("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(),
            "component-links")
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
