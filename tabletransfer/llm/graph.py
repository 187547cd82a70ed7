"""Connected components by repeated contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.shared import keep


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in the edges ``a, b``.

    Each round every id follows its neighbour of the lowest random priority, and the edges
    are redrawn between those followed. The ids left shrink by a constant factor a round, so
    long chains need few rounds. Rounds are written tables: lineage does not grow.
    Loops, repeated edges and an empty table are fine; edges with a null end are ignored.
    """
    edges = keep(edges.select("a", "b").where("a != b").distinct(), "edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    labels = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c: F.xxhash64(F.lit(turn), c)  # noqa: B023, E731
        follow = keep(
            edges.union(edges.select("b", "a"))
            .groupBy(F.col("a").alias("id"))
            .agg(F.min_by("b", rank(F.col("b"))).alias("best"))
            .select("id", F.when(rank(F.col("best")) < rank(F.col("id")), F.col("best"))
                    .otherwise(F.col("id")).alias("to")),
            "follow")
        labels = follow if labels is None else (
            labels.join(follow.select(F.col("id").alias("to"), F.col("to").alias("next")), "to", "left")
            .select("id", F.coalesce("next", "to").alias("to")))
        edges = keep(
            edges.join(follow.select(F.col("id").alias("a"), F.col("to").alias("p")), "a")
            .join(follow.select(F.col("id").alias("b"), F.col("to").alias("q")), "b")
            .where("p != q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(),
            "edges")
    if labels is None:
        return ids.select("id", F.col("id").alias("component"))
    labels = keep(labels, "labels")
    least = labels.groupBy("to").agg(F.min("id").alias("component"))
    return keep(labels.join(least, "to").select("id", "component"), "components")
