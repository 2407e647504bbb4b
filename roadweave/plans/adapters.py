"""The driver's star schema seen as a road network, and the same in SQL for the oracle.

Nations are units, orders are trips, and the nations of an order's suppliers, by line, are its path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, dst, miles of the directed graph; parallel edges keep the shortest."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    ring = n.select(F.col("n").alias("src"), ((F.col("n") + 1) % 25).alias("dst"), (F.col("n") % 7 + 1).alias("miles"))
    chords = n.select(F.col("n").alias("src"), ((7 * F.col("n") + 3) % 25).alias("dst"), (F.col("n") % 5 + 3).alias("miles"))
    return ring.unionByName(chords).where("src <> dst").groupBy("src", "dst").agg(F.min("miles").alias("miles"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trip_id, vehicle, vehicle_type (1 to 5), entime, fee, path, enid, exid."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    units = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("unit"))
    stops = lines.join(units, "l_suppkey").groupBy(F.col("l_orderkey").alias("trip_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "unit"))).alias("stops"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("vehicle"), F.substring("o_orderpriority", 1, 1).cast("int").alias("vehicle_type"), F.col("o_orderdate").alias("entime"), F.col("o_totalprice").cast("decimal(15,2)").alias("fee"))
    found = orders.join(stops, "trip_id").withColumn("path", F.transform("stops", lambda s: s["unit"])).drop("stops")
    return found.withColumn("enid", F.element_at("path", 1)).withColumn("exid", F.element_at("path", -1))


def timed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trips with the time of each visit: 40 minutes apart."""
    return trips(spark, sf_dir).withColumn("times", F.transform("path", lambda _, i: F.col("entime") + F.make_dt_interval(mins=i * 40)))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive trips of a vehicle: events by user, from one event type to the next."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").alias("vehicle"), F.col("event_type").alias("enid"), F.reverse("event_type").alias("exid"), F.col("ts").alias("entime"), (F.col("ts") + F.expr("interval 5 minutes")).alias("extime"), "value")


SQL = {
    "edges": """edges as (
        select src, dst, min(miles) as miles from (
            select n_nationkey as src, (n_nationkey + 1) % 25 as dst, n_nationkey % 7 + 1 as miles from nation
            union all select n_nationkey, (7 * n_nationkey + 3) % 25, n_nationkey % 5 + 3 from nation)
        where src <> dst group by src, dst)""",
    "trips": """trips as (
        select trip_id, vehicle, vehicle_type, entime, fee, path, path[1] as enid, path[-1] as exid from (
            select o_orderkey as trip_id, o_custkey as vehicle, substr(o_orderpriority, 1, 1)::int as vehicle_type, o_orderdate as entime, o_totalprice::decimal(15, 2) as fee,
                list(s_nationkey order by l_linenumber, l_partkey, l_suppkey) as path
            from orders join lineitem on o_orderkey = l_orderkey join supplier on l_suppkey = s_suppkey
            group by all))""",
    "visits": """visits as (
        select event_id, user_id as vehicle, event_type as enid, reverse(event_type) as exid, ts as entime, ts + interval 5 minutes as extime, value from events)""",
}


def with_(*names: str) -> str:
    return "with " + ", ".join(SQL[n] for n in names)
