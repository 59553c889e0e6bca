"""Connected components by contraction, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, land, name: str) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the
    smallest node of its component.

    Each turn every node points to its smallest neighbour (or itself), two
    such steps at once, and the edges are rewritten to where their ends point;
    edges within one node go. A component's smallest node always points to
    itself, so it is what remains. Turns grow with the logarithm of a
    component's length.
    """
    edges = land.put(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .where("a <> b").distinct(), f"{name}-start")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    turn, last_labels = 0, None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = land.put(both.groupBy("a").agg(F.min("b").alias("m"))
                      .select("a", F.least("a", "m").alias("p")), f"{name}-up{turn}")
        step = up.alias("x").join(up.alias("y"), F.col("x.p") == F.col("y.a"))
        up = land.put(step.select(F.col("x.a").alias("v"), F.col("y.p").alias("p")), f"{name}-jump{turn}")
        end_a = up.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        end_b = up.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        nxt = (edges.join(end_a, "a").join(end_b, "b").where("pa <> pb")
               .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        edges = land.put(nxt, f"{name}-edges{turn}")
        labels = land.put(labels.join(up.withColumnRenamed("v", "label"), "label", "left")
                          .select("node", F.coalesce("p", "label").alias("label")), f"{name}-labels{turn}")
        land.drop(f"{name}-up{turn}", f"{name}-jump{turn}", f"{name}-edges{turn - 1}", f"{name}-labels{turn - 1}")
        turn += 1
    return labels
