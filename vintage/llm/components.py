"""Connected components of an edge table by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.common import cut, discard


def _toward_least(links: DataFrame) -> DataFrame:
    """Each neighbour (and each key) of a key linked to the least of them. links: (key, other)."""
    least = links.groupBy("key").agg(F.min("other").alias("low")).select("key", F.least("key", "low").alias("low"))
    return links.join(least, "key")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("key"), F.col("v").alias("other")).unionAll(
        edges.select(F.col("v").alias("key"), F.col("u").alias("other"))
    )
    return (
        _toward_least(both)
        .where("other > key")
        .select(F.col("other").alias("u"), F.col("low").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("key"), F.least("u", "v").alias("other"))
    joined = _toward_least(down)
    return (
        joined.select(F.col("other").alias("u"), F.col("low").alias("v"))
        .unionAll(joined.select(F.col("key").alias("u"), F.col("low").alias("v")))
        .where("u <> v")
        .distinct()
    )


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node that it reaches.

    Rounds of large-star and small-star rewrite the edges until they form stars. Least
    neighbours are partial minima, and the joins behind them can be split where a node
    is the neighbour of very many. Each round is written to the shared folder. Self
    loops and repeated edges change nothing; an empty table gives an empty one.
    """
    now = cut(edges.select("u", "v").where("u <> v").distinct())
    for _ in range(max_rounds):
        last, now = now, cut(_small_star(_large_star(now)))
        discard(last)
        roots = now.select(F.col("v").alias("u"), F.lit(1).alias("root")).distinct()
        seen = now.groupBy("u").agg(F.count("*").alias("n"))
        open_ = seen.join(roots, "u", "left").where("n > 1 OR root = 1").limit(1)
        if not open_.take(1):
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
