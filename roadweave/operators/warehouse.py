"""Daily capacity, demand, impact and toll results: the relational builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import band_join

#: Passenger-car units of the vehicle classes 1 to 6, and vehicles an hour of a lane by design speed. Fixed values.
PCU = {1: 1.0, 2: 1.5, 3: 2.0, 4: 3.0, 5: 2.5, 6: 1.0}
LANE_CAPACITY = {120: 2200, 100: 2100, 80: 2000, 60: 1800}


def pcu_factor(vehicle_type: Column, factors: dict[int, float] = PCU) -> Column:
    out = F.lit(1.0)
    for kind, factor in factors.items():
        out = F.when(vehicle_type == kind, F.lit(factor)).otherwise(out)
    return out


def od_path_stats(trips: DataFrame, keys: Sequence[str], value: str, least_trips: int = 10) -> DataFrame:
    found = trips.groupBy(*keys).agg(F.count("*").alias("trip_count"), F.sum(value).alias("sum_value"), (F.sum(value).cast("double") / F.count(value)).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))
    return found.where(F.col("trip_count") >= least_trips)


def daily_demand(trips: DataFrame, keys: Sequence[str], day: Column, vehicle_type: str) -> DataFrame:
    """Trips and passenger-car units of each day, key and vehicle type."""
    return trips.groupBy(day.alias("stat_day"), *keys, vehicle_type).agg(F.count("*").alias("flow"), F.sum(pcu_factor(F.col(vehicle_type))).alias("flow_pcu"))


def roll_up(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))


def lane_level(lanes: Column) -> Column:
    lanes = F.coalesce(lanes, F.lit(1))
    return F.when(lanes >= 2, "high").when(lanes == 1, "medium").otherwise("low")


def capacity_days(works: DataFrame, rules: DataFrame) -> DataFrame:
    """Capacity of each section under works and day. works: section, start, end (dates, inclusive), lanes, open_lanes; rules: lanes, capacity.

    The capacity is that of the open lanes, and is scaled by their share again: both are part of the rule.
    """
    days = works.withColumn("stat_day", F.explode(F.sequence("start", "end", F.expr("interval 1 day"))))
    rule = rules.select(F.col("lanes").alias("rule_lanes"), "capacity")
    found = days.join(rule, F.col("open_lanes") == F.col("rule_lanes"))
    share = F.col("open_lanes") / F.nullif("lanes", F.lit(0))
    return found.select("section", "stat_day", F.col("capacity").alias("design_capacity"), F.round(F.col("capacity") * share).cast("int").alias("capacity"))


def impact_ratio(capacity: Column, flow: Column) -> Column:
    """0 where the capacity suffices, else the share of the flow beyond it, 1 at most."""
    return F.when(capacity >= flow, F.lit(0.0)).otherwise(F.least(F.lit(1.0), (flow - capacity) / F.nullif(flow, F.lit(0.0))))


def impacted_flow(capacity: DataFrame, flow: DataFrame, on: Sequence[str]) -> DataFrame:
    """capacity (keys, capacity) with demand (keys, flow): ratio, impacted flow (rounded half away from zero) and level."""
    found = capacity.join(flow, list(on), "left").withColumn("flow", F.coalesce("flow", F.lit(0.0)))
    found = found.withColumn("impact_ratio", impact_ratio(F.col("capacity").cast("double"), F.col("flow")))
    level = F.when(F.col("impact_ratio") >= 0.5, "high").when(F.col("impact_ratio") >= 0.2, "medium").when(F.col("impact_ratio") > 0, "low").otherwise("none")
    return found.withColumn("impacted_flow", F.round(F.col("flow") * F.col("impact_ratio")).cast("int")).withColumn("level", level)


def range_rules(rows: DataFrame, rules: DataFrame, x: str, y: str, kind: str, day: str) -> DataFrame:
    """Each row with the rule whose half-open bands hold x and y, whose vehicle type is the row's or any (null), and that is valid on the day.

    rules: rule_id, x_min, x_max, y_min, y_max, rule_type, valid_from, valid_to (null: open), ratio.
    """
    own = F.col("rule_type").isNull() | (F.col(kind) == F.col("rule_type"))
    valid = (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) <= F.col("valid_to")))
    return band_join(rows, rules, x, y, own & valid).drop("x_min", "x_max", "y_min", "y_max", "rule_type", "valid_from", "valid_to")


def scheme_summary(results: DataFrame, sections: DataFrame, schemes: DataFrame, key: str) -> DataFrame:
    """One row a scheme: impacted flow, distinct pairs, fees with and without loss, and its number of sections."""
    loss = F.col("fee_diff")
    found = results.groupBy(key).agg(
        F.sum("flow").alias("total_flow"), F.countDistinct("enid", "exid").alias("od_pairs"),
        F.sum(F.when(loss < 0, -loss).otherwise(0.0)).alias("loss_fee"), F.sum(F.when(loss > 0, loss).otherwise(0.0)).alias("gain_fee"),
    )
    counts = sections.groupBy(key).agg(F.count("*").alias("section_count"))
    out = schemes.join(found, key, "left").join(counts, key, "left")
    return out.fillna(0, ["total_flow", "od_pairs", "section_count"]).fillna(0.0, ["loss_fee", "gain_fee"])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], recency: str) -> DataFrame:
    """old and new by key, the most recent row winning, new before old if equally recent."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    by = Window.partitionBy(*keys).orderBy(F.desc(recency), F.desc("_new"))
    return both.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n", "_new")


def accumulate(old: DataFrame, new: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return roll_up(old.unionByName(new), keys, measures)


def insert_missing(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new, one a key, whose keys old lacks."""
    return new.dropDuplicates(list(keys)).join(old, list(keys), "left_anti")
