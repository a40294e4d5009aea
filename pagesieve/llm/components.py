"""Connected components of a large undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (BIGINT) -> ``id, component`` for every node of an edge.

    Every node points to the neighbour (or itself) with the smallest hash, a new
    hash in every round; nodes that point to one another become one and the edges
    between them go. With random hashes the edges shrink by a constant factor a
    round, whatever the shape. A node with many edges is one sum in the minimum,
    which is combined before the shuffle. ``component`` is one of its ids.
    """
    spark, root = edges.sparkSession, work_path(edges.sparkSession, "components")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    left = stored(edges.where("a <> b").select(both.alias("e")).select("e.a", "e.b").distinct(), "edges-0")
    labels, turn = None, 0
    while not left.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("id"))  # noqa: B023, E731
        nearest = left.groupBy("a").agg(F.least(F.min(rank(F.col("b"))), F.first(rank(F.col("a")))).alias("m"))
        moves = stored(nearest.select("a", F.col("m.id").alias("to")), f"moves-{turn}")
        if labels is None:
            labels = stored(moves.select(F.col("a").alias("id"), F.col("to").alias("component")), f"labels-{turn}")
        else:
            moved = labels.join(moves, labels["component"] == moves["a"], "left")
            labels = stored(moved.select("id", F.coalesce("to", "component").alias("component")), f"labels-{turn}")
        ends = left.join(moves.withColumnRenamed("to", "x"), "a").select("x", "b").join(
            moves.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        left = stored(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
                      f"edges-{turn}")
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
