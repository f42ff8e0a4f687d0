"""Connected components by repeated contraction, as joins and aggregates.

Each round points every node at its smallest neighbour, follows the pointers once,
and contracts: links inside a merged node vanish and parallel ones merge.  A chain
shrinks by a factor in every round, so the rounds follow the logarithm of the size.
Each round's tables are written below the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.sources.shared import new_path, write_options


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.options(**write_options(spark, path)).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of a link; a component is its smallest node.

    links: columns ``a`` and ``b`` (long), in any order; null ends are ignored,
    repeated links and links of a node with itself are allowed.
    """
    links = links.where("a is not null and b is not null").select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), "links")
    label = None
    while not edges.isEmpty():
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select(F.col("a").alias("node"), F.least("a", "low").alias("to"))
        low = written(low, "pointers")
        then = low.select(F.col("node").alias("to"), F.col("to").alias("then"))
        jump = low.join(then, "to").select("node", F.col("then").alias("to"))
        jump = written(jump, "pointers")
        if label is None:
            label = jump.select("node", F.col("to").alias("component"))
        else:
            moved = jump.select(F.col("node").alias("component"), "to")
            label = label.join(moved, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
            label = written(label, "labels")
        for end in ("a", "b"):
            moved = jump.select(F.col("node").alias(end), "to")
            other = "b" if end == "a" else "a"
            edges = edges.join(moved, end).select(F.col("to").alias(end), other)
        edges = written(edges.where("a <> b").distinct(), "links")
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
