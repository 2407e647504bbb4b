"""Joins by order and by range as joins on keys: the last row at or before a time, and bands of two measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import stored

#: Bins a measure, at most, into which the bounds of rules cut it.
BINS = 32


def asof_join(left: DataFrame, right: DataFrame, at: str, keys: Sequence[str] = (), value: str = "value", ranges: int | None = None) -> DataFrame:
    """left with `value` of the last row of right of the same keys that isn't after it (equal times count); null where there is none.

    left: keys, at and more; right: keys, at, value. Of rows of right with equal times the largest value counts; rows of right without a time go, rows of left
    without one find nothing. Both are dealt together to ranges of keys and time and stored, so a key that many rows share is cut in
    pieces; within a range the last value is carried by a window, and what a range's first rows of a key lack comes from the last earlier
    range that has one, of which there is a row a key and range. Nulls in keys are equal to each other.
    """
    n = ranges or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names, kind = [f"_k{i}" for i in range(len(keys))], dict(right.dtypes)[value]
    mine = left.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_value"), F.struct(*left.columns).alias("_row"))
    theirs = right.where(F.col(at).isNotNull()).select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(at).cast(dict(left.dtypes)[at]).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_value"))
    both = mine.unionByName(theirs, allowMissingColumns=True)
    order = [*names, "_at", "_side", "_value", F.xxhash64("_row")]
    parts = stored(both.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "asof-ranges")
    last = F.last("_value", ignorenulls=True)
    near = parts.withColumn("_near", last.over(Window.partitionBy("_range", *names).orderBy("_at", "_side", "_value").rowsBetween(Window.unboundedPreceding, 0)))
    ends = parts.groupBy("_range", *names).agg(F.max(F.when(F.col("_side") == 0, F.struct("_at", "_value"))).alias("_end"))
    before = Window.partitionBy(*names, *([] if names else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last(F.col("_end"), ignorenulls=True).over(before)["_value"]).select("_range", *(F.col(n).alias(f"{n}_") for n in names), "_carried").where("_carried is not null")
    same = near["_range"] == carried["_range"]
    for k in names:
        same = same & near[k].eqNullSafe(carried[f"{k}_"])
    found = near.where("_side = 1").join(carried, same, "left")
    got = F.when(F.col("_at").isNotNull(), F.coalesce("_near", "_carried"))
    return found.select("_row.*", got.alias(value))


def cuts(bounds: DataFrame, low: str, high: str) -> list:
    """Up to BINS values that cut the bounds of rules into equal parts."""
    ends = bounds.select(F.explode(F.array(F.col(low).cast("double"), F.col(high).cast("double"))).alias("end")).where("end is not null")
    found = ends.agg(F.percentile_approx("end", [i / (BINS - 1) for i in range(BINS)], 10_000).alias("at")).first()["at"]
    return sorted(set(found or []))


def bin_of(x: Column, at: Sequence[float]) -> Column:
    """How many of the cuts lie at or below x; 0 for null."""
    return F.size(F.filter(F.array(*(F.lit(float(c)) for c in at)), lambda c: c <= x.cast("double"))) if at else F.lit(0)


def band_join(rows: DataFrame, rules: DataFrame, x: str, y: str, more: Column | None = None, how: str = "left") -> DataFrame:
    """rows with each rule whose half-open bands [x_min, x_max) and [y_min, y_max) hold x and y, and for which `more` is true; left: rows without one too.

    The rules' own bounds cut both measures into bins. A row lies in one bin of each, a rule comes once for each pair of bins that its bands
    meet (at most BINS + 1 squared), and both meet on these. Runs two small jobs over the rules when called.
    """
    at_x, at_y = cuts(rules, "x_min", "x_max"), cuts(rules, "y_min", "y_max")
    mine = rows.withColumns({"_bx": bin_of(F.col(x), at_x), "_by": bin_of(F.col(y), at_y)})
    set_ = rules.where("x_min < x_max and y_min < y_max")
    span = lambda a, b, at: F.explode(F.sequence(bin_of(F.col(a), at), bin_of(F.col(b), at)))
    theirs = set_.withColumn("_rx", span("x_min", "x_max", at_x)).withColumn("_ry", span("y_min", "y_max", at_y))
    on = (mine["_bx"] == theirs["_rx"]) & (mine["_by"] == theirs["_ry"]) & (mine[x] >= theirs["x_min"]) & (mine[x] < theirs["x_max"]) & (mine[y] >= theirs["y_min"]) & (mine[y] < theirs["y_max"])
    return mine.join(theirs, on if more is None else on & more, how).drop("_bx", "_by", "_rx", "_ry")
