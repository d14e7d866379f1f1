"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation with a map-side part and a join; nothing is
collected but a count and a hash sum. Each round is written to the shared folder, which cuts the
lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and itself, move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    moved = edges.join(least, F.col("a") == F.col("u")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame, path: str, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``edges`` (columns a, b): the least node of its component.

    Nodes without an edge are not listed. ``path`` is a new folder for the rounds.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = _written(now, f"{path}/0")
    state = _state(now)
    for k in range(1, most_rounds + 1):
        if not state[0]:
            break
        now = _written(_small_star(_large_star(now).where("a > b").distinct()).distinct(), f"{path}/{k}")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
