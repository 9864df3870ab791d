"""Connected components of an edge table, by contraction.

Each round every vertex hooks onto its smallest neighbour (a map-side combined
minimum, so a vertex with a third of all edges is one row per task before the
shuffle), chains of hooks are halved until they reach their roots, and the edges are
rewritten between roots. Edges inside a component vanish, so tables shrink with each
round. Every table is written to the shared folder; nothing of the graph comes to
the driver but whether a table is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` bigint -> ``(v, root)`` for every vertex that is not its own root;
    the root of a component is its smallest vertex. Self edges and repeats are harmless;
    no edges give no rows."""
    left = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    whole: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(both.groupBy("a").agg(F.min("b").alias("m")).where("m < a")
                       .select(F.col("a").alias("v"), F.col("m").alias("root")), "hooks")
        while True:
            nxt = hooks.select(F.col("v").alias("root"), F.col("root").alias("up"))
            halved = stored(hooks.join(nxt, "root", "left")
                            .select("v", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "hooks")
            moved = not halved.where("moved").isEmpty()
            hooks = halved.drop("moved")
            if not moved:
                break
        if whole is None:
            whole = hooks
        else:
            up = hooks.select(F.col("v").alias("root"), F.col("root").alias("up"))
            whole = stored(whole.join(up, "root", "left").select("v", F.coalesce("up", "root").alias("root"))
                           .unionByName(hooks), "roots")
        left = stored(relabel(relabel(left, hooks, "a"), hooks, "b").where("a <> b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    return whole if whole is not None else left.select(F.col("a").alias("v"), F.col("b").alias("root"))


def relabel(df: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """Replace vertices in ``column`` by their roots."""
    to = roots.select(F.col("v").alias(column), F.col("root").alias("_root"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")
