"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored

MAX_ROUNDS = 60


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and all its neighbours; the minimum is pre-aggregated."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Large-star leaves v <= u, so v are the smaller neighbours of u.
    found = _with_least(edges.filter("v < u"))
    moved = found.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(found.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of its component.

    `edges` has two columns u and v of one orderable type; direction, loops and repeats do not matter,
    and edges with a null are ignored. Each round is stored and only its size and a checksum come to
    the driver. The number of rounds grows with the logarithm of the longest path.
    """
    now = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), F.col("u").alias("a"), F.col("v").alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND u != v")
        .select("u", "v")
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        now = stored(_small_star(_large_star(now)), "edges")
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
