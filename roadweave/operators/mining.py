"""Mining of vehicles and sections from trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def vehicle_frequency(trips: DataFrame, keys: Sequence[str] = ("enid", "exid", "vehicle", "vehicle_type"), top: int | None = None) -> DataFrame:
    """How often each vehicle makes each trip, most often first; top: the report's length."""
    found = trips.groupBy(*keys).agg(F.count("*").alias("freq"))
    return found.orderBy(F.desc("freq"), *keys).limit(top) if top else found


def greedy_prefix(flows: DataFrame, wanted: DataFrame, keys: Sequence[str], flow: str, tie: str, x: str = "flow_x") -> DataFrame:
    """Allocates each key's wanted flow to its paths, smallest flows first, the last in part. Paths that get nothing go."""
    by = Window.partitionBy(*keys).orderBy(flow, tie).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(flow).over(by), F.lit(0))
    both = flows.join(wanted, list(keys)).withColumn("allocated", F.greatest(F.lit(0), F.least(F.col(flow), F.col(x) - before)))
    return both.where("allocated > 0")


def section_flow(paths: DataFrame, path: str, flow: str, skip: Sequence[str] = ()) -> DataFrame:
    """Flow of each section over all its visits, without the columns of sections named by `skip`."""
    each = paths.select(F.explode(path).alias("section"), flow, *skip)
    for c in skip:
        each = each.where(F.col("section") != F.col(c))
    return each.groupBy("section").agg(F.sum(flow).alias("flow"))


def tagged(trips: DataFrame, tags: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """trips with `tags`: the names, comma-joined, of the key sets that hold the row's key. tags: name to (keys, columns)."""
    flags = []
    for i, (name, (keys, on)) in enumerate(tags.items()):
        trips = trips.join(keys.select(*on).distinct().withColumn(f"_tag{i}", F.lit(name)), list(on), "left")
        flags.append(f"_tag{i}")
    return trips.withColumn("tags", F.concat_ws(",", *flags)).drop(*flags)


def unordered_key(a: str, b: str):
    return F.concat_ws("|", F.least(a, b).cast("string"), F.greatest(a, b).cast("string"))
