"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge to another: root is the smallest node that it is connected with.

    A round costs four shuffles of the edges; the number of rounds grows with the logarithm of the diameter. Minima are
    aggregated before they are shuffled and joins on a hub are split by adaptive execution, so a node with a third of all
    edges does not land in one task. Each round is written to the shared folder.
    """
    low, high = F.least(F.col(u), F.col(v)), F.greatest(F.col(u), F.col(v))
    now = stored(edges.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "components")
    before = _state(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
        last, now = now, stored(small.where("u <> v").distinct(), "components")
        discard(last)
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
