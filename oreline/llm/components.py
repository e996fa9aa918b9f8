"""Connected components of a link table by alternating large and small stars.

Every step is a group-by that folds map-side and a join of two stored tables, so a node with many
links is split by the adaptive skew join. No link or component passes through the driver: it sees
two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import stored


# Rows of a link table that one task writes.
TASK_ROWS = 1_000_000


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = stored(links.unionByName(back).coalesce(2 * tasks), "cc-both")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = stored(least.coalesce(tasks), "cc-least")
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return stored(moved.coalesce(tasks), "cc-large")


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    least = stored(links.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), "cc-least")
    joined = links.join(least, "a").where(F.col("b") != F.col("m"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = moved.unionByName(least.withColumnRenamed("m", "b")).distinct()
    return stored(moved.coalesce(tasks), "cc-small")


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b of type long); root is the smallest node.

    Self links and repeated links are allowed; an empty table gives an empty result.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = stored(ordered.where(F.col("a") != F.col("b")).distinct(), "cc-start")
    before, now = None, _state(stars)
    while now != before:
        tasks = 1 + now[0] // TASK_ROWS
        stars = _small_star(_large_star(stars, tasks), tasks)
        before, now = now, _state(stars)
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
