"""Tolls of paths and of origin-destination pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def path_fees(paths: DataFrame, units: DataFrame, rates: DataFrame, id_col: str, path: str = "path", kind: str = "vehicle_type") -> DataFrame:
    """Fee, length and the same on control roads of each path and vehicle type.

    units: unit, length (m), roadtype, feektype, feehtype, is_control; passenger types 1 to 4 pay by feektype, others by
    feehtype. rates: roadtype, feetype, vehicle_type, feebykm. A unit's length counts also where no rate is found; an
    unknown unit counts for nothing. Both tables are dimensions; Spark broadcasts them if their size allows it.
    """
    each = paths.select(id_col, kind, F.explode_outer(path).alias("unit")).join(units, "unit", "left")
    each = each.withColumn("feetype", F.when(F.col(kind).cast("int").between(1, 4), F.col("feektype")).otherwise(F.col("feehtype")))
    each = each.join(rates, ["roadtype", "feetype", kind], "left")
    fee = F.when(F.col("roadtype").isin(1, 2), F.col("feebykm") * F.col("length") / 1000.0)
    control = F.coalesce("is_control", F.lit(False))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    metres = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    return each.groupBy(id_col, kind).agg(total(fee).alias("fee"), metres(F.col("length")).alias("length_m"), total(F.when(control, fee)).alias("control_fee"), metres(F.when(control, F.col("length"))).alias("control_length_m"))


def od_toll(direct: DataFrame, shortest: DataFrame, keys: list[str], compare: str = "max") -> DataFrame:
    """The toll of a pair from its own path and the shortest one: the larger of both (compare="min": the smaller), null counting as none."""
    both = direct.select(*keys, F.col("fee").alias("path_fee")).join(shortest.select(*keys, F.col("fee").alias("shortest_fee")), keys, "left")
    return both.withColumn("fee", (F.greatest if compare == "max" else F.least)("path_fee", "shortest_fee"))


def fees_by_type(paths: DataFrame, units: DataFrame, rates: DataFrame, id_col: str, path: str = "path") -> DataFrame:
    """path_fees for every vehicle type of the rates. There are few types; up to 1,000 are broadcast, more are refused."""
    types = rates.select("vehicle_type").distinct().limit(1001)
    if types.count() > 1000:
        raise ValueError("more than 1000 vehicle types")
    return path_fees(paths.drop("vehicle_type").crossJoin(F.broadcast(types)), units, rates, id_col, path)


def fees_of_distinct(paths: DataFrame, units: DataFrame, rates: DataFrame, path: str = "path", kind: str = "vehicle_type") -> DataFrame:
    """paths with the columns of path_fees; each different path and type is priced once, however many rows take it.

    Rows meet their price by a hash of path and type, and by both.
    """
    keyed = paths.withColumn("_hash", F.xxhash64(path, kind))
    one = keyed.select("_hash", path, kind).distinct()
    priced = path_fees(one.withColumn("_one", F.struct("_hash", path)), units, rates, "_one", path, kind)
    priced = priced.select(F.col("_one._hash").alias("_hash"), F.col(f"_one.{path}").alias("_path"), F.col(kind).alias("_kind"), *(c for c in priced.columns if c not in ("_one", kind)))
    same = (keyed["_hash"] == priced["_hash"]) & keyed[path].eqNullSafe(priced["_path"]) & keyed[kind].eqNullSafe(priced["_kind"])
    return keyed.join(priced, same).drop("_hash", "_path", "_kind")


#: Fixed value: the nature of roads that are still being paid off, which makes their units control units.
PAID_OFF = "还贷性"


def with_control_roads(units: DataFrame, roads: DataFrame, road: str = "roadid", nature: str = "nature") -> DataFrame:
    """units with `is_control`: whether the road named by the first 11 characters of its number is of that nature; false where unknown.

    roads: road number, nature. Repeated roads count once.
    """
    control = roads.where(F.col(nature) == PAID_OFF).select(F.col(road).alias("_road")).distinct().withColumn("_control", F.lit(True))
    found = units.join(control, F.substring(units[road], 1, 11) == F.col("_road"), "left")
    return found.withColumn("is_control", F.coalesce("_control", F.lit(False))).drop("_road", "_control")
