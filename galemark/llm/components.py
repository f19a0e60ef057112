"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from galemark.llm.common import save


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of `links` (a, b: longs), component the smallest node reached.

    Alternating large-star and small-star steps: each replaces a link by one to the smallest
    neighbour, so rows never multiply and the number of rounds grows with the logarithm of the
    component.  A node with very many links is a hot join key, which adaptive joins split; its
    smallest neighbour is a partial aggregate.  No links give no rows; loops and repeats do no harm.
    """
    links = save(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(),
        "links",
    )
    for _ in range(rounds):
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = save(small, "links")
        if not _differ(links, after):
            break
        links = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(links.select("v", "v").distinct())


def _differ(a: DataFrame, b: DataFrame) -> bool:
    def sums(df):
        h = F.xxhash64("u", "v")
        return df.agg(
            F.count("*"), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))
        ).first()

    return sums(a) != sums(b)
