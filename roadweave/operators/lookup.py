"""Lookups: sets that match as a whole, chains of maps, vertices, adjacency, pages of neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_sets(left: DataFrame, right: DataFrame, left_id: str, right_id: str, members: Sequence[str]) -> DataFrame:
    """Pairs of ids whose sets of members are equal. The sorted set itself is the join key."""
    as_set = lambda df, key: df.groupBy(key).agg(F.sort_array(F.collect_set(F.struct(*members))).alias("members"))
    return as_set(left, left_id).join(as_set(right, right_id), "members").select(left_id, right_id)


def first_of(df: DataFrame, key: str, maps: Sequence[tuple[DataFrame, str, str]], out: str) -> DataFrame:
    """df with the value that the first of several maps has for key. maps: (map, its key, its value); a map with several values gives the smallest."""
    found = []
    for i, (m, k, v) in enumerate(maps):
        df = df.join(m.groupBy(F.col(k).alias(f"_k{i}")).agg(F.min(v).alias(f"_v{i}")), F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        found.append(f"_v{i}")
    return df.withColumn(out, F.coalesce(*found)).drop(*found)


def vertices(edges: DataFrame, src: str = "src", dst: str = "dst", name_src: str | None = None, name_dst: str | None = None) -> DataFrame:
    """Distinct ends of edges; with names, the one that a vertex has as a source goes first, then the smallest."""
    part = lambda c, n, order: edges.select(F.col(c).alias("node"), (F.col(n) if n else F.lit(None).cast("string")).alias("name"), F.lit(order).alias("o"))
    both = part(src, name_src, 0).unionByName(part(dst, name_dst, 1))
    return both.groupBy("node").agg(F.min_by("name", F.struct("o", "name")).alias("name"))


def adjacency(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.groupBy(src).agg(F.sort_array(F.collect_set(dst)).alias("next"))


def random_rows(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A random sample of n rows: those whose key, hashed with the seed, comes first. A rerun gives the same rows."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
