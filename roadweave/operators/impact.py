"""Construction impact: affected pairs, trips broken off midway, detours, the summary and the loss analysis."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.measures import MEASURES, derived_impact, safe_div
from ..shared import stored


def mid_trip_exits(trips: DataFrame, ods: DataFrame, hours: float = 6.0, vehicle: str = "vehicle") -> DataFrame:
    """Pairs of trips in which a vehicle left midway and went on: consecutive trips, at most `hours` apart, that together make a wanted pair.

    trips: vehicle, enid, exid, entime, extime, event_id (decides between equal times). ods: enid, exid. Only trips that
    start at a wanted origin or end at a wanted destination count as a vehicle's trips, which is part of the definition.
    The two sets are semi-joined, the only wide step is the window by vehicle.
    """
    starts, ends = ods.select("enid").distinct().withColumn("_o", F.lit(True)), ods.select("exid").distinct().withColumn("_d", F.lit(True))
    mine = trips.join(starts, "enid", "left").join(ends, "exid", "left").where("_o or _d").drop("_o", "_d")
    by = Window.partitionBy(vehicle).orderBy("entime", "event_id")
    nxt = [F.lead(c).over(by).alias(f"next_{c}") for c in ("event_id", "enid", "exid", "entime")]
    both = mine.select("*", *nxt).where("next_event_id is not null")
    gap = (F.col("next_entime").cast("timestamp").cast("double") - F.col("extime").cast("timestamp").cast("double")) / 3600
    pair = ods.select(F.col("enid"), F.col("exid").alias("next_exid")).distinct()
    return both.where((gap >= 0) & (gap <= hours) & (F.col("exid") != F.col("next_enid"))).join(pair, ["enid", "next_exid"], "left_semi")


def without_used(trips: DataFrame, used: DataFrame, keys: Sequence[str] = ("vehicle", "entime")) -> DataFrame:
    return trips.join(used.select(*keys).distinct(), list(keys), "left_anti")


def detour_candidates(trips: DataFrame, ods: DataFrame, near: DataFrame) -> DataFrame:
    """Trips that stand for a wanted pair's by starting, or ending, near the works. near: unit. Adds od_enid, od_exid, record_type."""
    wanted = ods.select(F.col("enid").alias("od_enid"), F.col("exid").alias("od_exid")).distinct()
    near_o = wanted.join(near.select(F.col("unit").alias("od_enid")), "od_enid", "left_semi")
    near_d = wanted.join(near.select(F.col("unit").alias("od_exid")), "od_exid", "left_semi")
    to_d = trips.join(near_o, trips["exid"] == near_o["od_exid"]).where("enid <> od_enid").withColumn("record_type", F.lit("exit"))
    from_o = trips.join(near_d, trips["enid"] == near_d["od_enid"]).where("exid <> od_exid").withColumn("record_type", F.lit("entry"))
    return to_d.unionByName(from_o)


def path_types(paths: DataFrame, types: DataFrame, flows: DataFrame, id_col: str, kind: str, measure: str) -> DataFrame:
    """Each path with each observed vehicle type and its flow, 0 if none. There are few types; up to 1,000 are broadcast."""
    few = types.select(kind).distinct().limit(1001)
    if few.count() > 1000:
        raise ValueError("more than 1000 vehicle types")
    return paths.crossJoin(F.broadcast(few)).join(flows, [id_col, kind], "left").fillna(0, [measure])


def keep_affected(rows: DataFrame, least: int, con: str = "con_flow", same: str = "sp_flow") -> DataFrame:
    """Unaffected rows, and affected ones whose flow in either period is above `least`."""
    return rows.where(~F.col("is_affected") | (F.col(con) > least) | (F.col(same) > least))


def flow1(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Paths of each key pivoted by is_affected into con_ and other_ columns: mean fees, summed flows and lengths. Keys without affected flow in the same period go."""
    out = []
    for name, mine in (("con", F.col("is_affected")), ("other", ~F.col("is_affected"))):
        out += [F.coalesce(F.sum(F.when(mine, F.col(c))).cast("double") / F.nullif(F.count(F.when(mine, F.col(c))), F.lit(0)), F.lit(0.0)).alias(f"{name}_{c}") for c in ("fee", "control_fee")]
        out += [F.coalesce(F.sum(F.when(mine, F.col(c))), F.lit(0)).alias(f"{name}_{c}") for c in ("flow", "sp_flow", "length", "control_length")]
    return rows.groupBy(*keys).agg(*out).where("con_sp_flow > 0")


def flow_losses(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Flows and losses of each key with the loss of a vehicle, as `name`_ columns (mid or detour)."""
    found = rows.groupBy(*keys).agg(*(F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(f"{name}_{c}") for c in ("flow", "sp_flow", "loss_fee", "control_loss_fee")))
    for c in ("loss_fee", "control_loss_fee"):
        found = found.withColumn(f"{name}_unit_{c}", safe_div(F.col(f"{name}_{c}"), F.col(f"{name}_flow")))
    return found


def impact_summary(first: DataFrame, mid: DataFrame, detour: DataFrame, keys: Sequence[str]) -> DataFrame:
    """flow1 with the other two flows (0 where there are none) and the derived measures."""
    both = first.join(mid, list(keys), "left").join(detour, list(keys), "left")
    both = both.fillna(0.0, [c for c in both.columns if c.startswith(("mid_", "detour_"))])
    return both.withColumns(derived_impact())


def measure_roll_up(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The 13 measures summed; rows with a null or empty key go."""
    for k in keys:
        rows = rows.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return rows.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in MEASURES))


def shared_flow(rows: DataFrame, share: Sequence[str], od: Sequence[str], measure: str) -> DataFrame:
    """Flow of each record divided by the number of wanted pairs that share it."""
    pairs = rows.select(*share, *od).distinct()
    n = pairs.groupBy(*share).agg(F.count("*").alias("od_count"))
    return rows.groupBy(*share, *od).agg(F.sum(measure).alias("total")).join(n, list(share)).withColumn(measure, F.col("total") / F.col("od_count")).drop("total")


def loss_matrix(rows: DataFrame, row: str, column: str, values: Sequence, measure: str) -> DataFrame:
    """Summed measure of each row and column value, 0 where there is none. The values are stated, so no extra job finds them."""
    out = rows.groupBy(row).pivot(column, list(values)).agg(F.sum(measure))
    names = [str(v) for v in values]
    return out.select(row, *(F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(f"v{n}") for n in names))


def top_losses(rows: DataFrame, key: str, n: int = 15) -> DataFrame:
    """The n keys with the largest lost flow (ties by key) and their loss rate in percent, null without affected flow."""
    found = rows.groupBy(key).agg(F.sum("lost_flow").alias("lost_flow"), F.sum("affected_flow").alias("affected_flow"))
    return found.withColumn("loss_rate", F.round(F.col("lost_flow") * 100.0 / F.nullif("affected_flow", F.lit(0)), 1)).orderBy(F.desc("lost_flow"), key).limit(n)


def evaluation(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """One row a key: losses, main loss type and type of the highest loss rate; ties go to the smaller type."""
    by_type = rows.groupBy(key, kind).agg(F.sum("lost_flow").alias("lost"), F.sum("affected_flow").alias("affected"), F.sum("lost_control_fee").alias("fee"))
    rate = F.coalesce(F.col("lost") / F.nullif("affected", F.lit(0)), F.lit(-1.0))
    top = lambda by: F.max_by(F.col(kind), F.struct(by, -F.col(kind)))
    return by_type.groupBy(key).agg(F.sum("lost").alias("lost_flow"), F.sum("fee").alias("lost_fee"), top(F.col("lost")).alias("main_type"), top(rate).alias("highest_rate_type"))


#: Names of vehicle categories and what stands where there is no type. Fixed values.
CARS, LORRIES, NONE = "客车", "货车", "-"


def evaluation_table(rows: DataFrame, totals: DataFrame, key: str, kind: str, category: str, n: int = 15) -> DataFrame:
    """The n keys with the largest lost flow, labelled TOP01 on, with all that the loss report says of each.

    rows: key, kind (type name), category, affected_flow, lost_flow, lost_control_fee (in ten thousands); totals: key, ref_total_flow. Keys without totals go, after they were
    labelled. Rates are in percent, 0 where nothing is lost or affected. Types are named with their share of the lost flow and with their own rate; ties go to the
    name that sorts first. Halves are rounded to even.
    """
    by_type = rows.groupBy(key, kind, category).agg(*(F.sum(c).cast("double").alias(c) for c in ("affected_flow", "lost_flow", "lost_control_fee")))
    rate = F.when(F.col("affected_flow") > 0, F.col("lost_flow") * 100 / F.col("affected_flow"))
    # the larger first, then the smaller name: min_by with the value turned round
    first = lambda x: F.min(F.when(x.isNotNull(), F.struct((-x).alias("x"), F.col(kind).alias("kind"))))
    of = lambda name: F.coalesce(F.sum(F.when(F.col(category) == name, F.col("lost_flow"))), F.lit(0.0))
    found = by_type.groupBy(key).agg(*(F.sum(c).alias(c) for c in ("affected_flow", "lost_flow", "lost_control_fee")), first(F.col("lost_flow")).alias("_main"), first(rate).alias("_high"), of(CARS).alias("_cars"), of(LORRIES).alias("_lorries"))
    top = found.orderBy(F.desc("lost_flow"), key).limit(n)
    label = F.row_number().over(Window.orderBy(F.desc("lost_flow"), key))  # at most n rows
    top = top.withColumn("label", F.concat(F.lit("TOP"), F.lpad(label.cast("string"), 2, "0"))).join(totals.select(key, "ref_total_flow"), key)
    lost = F.col("lost_flow")
    share = lambda x, of: F.when(of > 0, x * 100 / of).otherwise(F.lit(0.0))
    named = lambda name, x: F.concat(name, F.lit("("), F.bround(x, 0).cast("bigint").cast("string"), F.lit("%)"))
    nothing = F.lit(f"{NONE}(0%)")
    return top.select(
        "label", key, "ref_total_flow", "affected_flow", "lost_flow", F.bround(share(lost, F.col("affected_flow")), 1).alias("loss_rate"), F.bround("lost_control_fee", 2).alias("lost_control_fee"),
        F.bround(F.when(lost > 0, F.col("lost_control_fee") / lost * 10000).otherwise(0.0), 0).alias("fee_per_vehicle"), F.when(lost > 0, named(F.col("_main.kind"), share(-F.col("_main.x"), lost))).otherwise(nothing).alias("main_type"),
        F.coalesce(named(F.col("_high.kind"), -F.col("_high.x")), nothing).alias("highest_rate_type"), F.bround(share(F.col("_cars"), lost), 1).alias("cars_share"), F.bround(share(F.col("_lorries"), lost), 1).alias("lorries_share"),
    )


def period_sum(measure: str, period: Column) -> Column:
    return F.coalesce(F.sum(F.when(period, F.col(measure))), F.lit(0))


def share_matrix(matrix: DataFrame, row: str) -> DataFrame:
    """A loss_matrix in percent of each row's sum, null where that is 0."""
    values = [c for c in matrix.columns if c != row]
    whole = F.nullif(sum((F.col(c).cast("double") for c in values), F.lit(0.0)), F.lit(0.0))
    return matrix.select(row, *((F.col(c) * 100.0 / whole).alias(c) for c in values))


def rate_matrix(rows: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Lost flow in percent of the affected flow of each row and column value; 0 where nothing is affected."""

    def rate(mine: Column) -> Column:
        lost, affected = (F.sum(F.when(mine, F.col(c))) for c in ("lost_flow", "affected_flow"))
        return F.coalesce(lost * 100.0 / F.nullif(affected, F.lit(0)), F.lit(0.0))

    return rows.groupBy(row).agg(*(rate(F.col(column) == v).alias(f"v{v}") for v in values), rate(F.lit(True)).alias("all"))


def affected_paths(paths: DataFrame, works: DataFrame) -> DataFrame:
    """Paths of every pair that some works affect, once for each such works: works_id, enid, exid, path_key, path, affected, is_affected, anchor.

    paths: enid, exid, path_key, path (one row each); works: works_id, units. A pair is affected if any of its paths visits any unit of the works.
    affected: the works' units that the path visits, in the works' order; anchor: the first of them, else the path's first unit. Paths
    meet works by unit, pairs by both ends.
    """
    units = works.select("works_id", F.posexplode("units").alias("nth", "unit"))
    visits = paths.select("enid", "exid", "path_key", F.explode(F.array_distinct("path")).alias("unit"))
    hit = visits.join(units, "unit").groupBy("works_id", "enid", "exid", "path_key").agg(F.sort_array(F.collect_set(F.struct("nth", "unit"))).alias("hit"))
    hit = stored(hit.withColumn("affected", F.array_distinct(F.transform("hit", lambda h: h["unit"]))).drop("hit"), "affected-paths")
    every = paths.join(hit.select("works_id", "enid", "exid").distinct(), ["enid", "exid"])
    found = every.join(hit, ["works_id", "enid", "exid", "path_key"], "left")
    none = F.coalesce("affected", F.array().cast(dict(hit.dtypes)["affected"]))
    return found.select("works_id", "enid", "exid", "path_key", "path", none.alias("affected"), F.col("affected").isNotNull().alias("is_affected"), F.coalesce(F.get("affected", F.lit(0)), F.get("path", F.lit(0))).alias("anchor"))


def anchor_flow(trips: DataFrame, works: DataFrame, keys: Sequence[str] = ("vehicle_type",), years: int = 1, path_key: Column | None = None) -> DataFrame:
    """Flow of each path that matters to a works, at its anchor, over the works' days and the same days `years` before, by vehicle type.

    trips: enid, exid, path, times (of each visit) and keys; works: works_id, units, start, end (days, both included). Returns works_id, enid, exid, path_key, affected,
    is_affected, anchor, keys, con_flow, sp_flow. What counts is the hour at which the anchor is passed, not that of entry; a trip counts once for an hour at it. Each path comes with every
    vehicle type that any of the works' paths had in either period (`0` if none had), but an affected path without flow in both goes.
    Trips are counted by path, unit and hour before works are joined; only visits of units that anchor their path are counted.
    """
    text = F.array_join(F.col("path").cast("array<string>"), "|") if path_key is None else path_key
    mine = trips.withColumn("path_key", text)
    paths = mine.select("enid", "exid", "path_key", "path").groupBy("enid", "exid", "path_key").agg(F.first("path").alias("path"))
    wanted = stored(affected_paths(paths, works), "anchors-wanted")
    anchors = wanted.groupBy("enid", "exid", "path_key").agg(F.collect_set("anchor").alias("anchors"))
    visits = F.transform(F.arrays_zip(F.col("path").alias("unit"), F.col("times").alias("at")), lambda v: F.struct(v["unit"].alias("unit"), F.date_trunc("hour", v["at"]).alias("hour")))
    # only trips with a visit in the span of all periods are shuffled
    span = works.agg(F.min(F.least("start", F.add_months("start", -12 * years))).alias("_first"), F.max(F.greatest("end", F.add_months("end", -12 * years))).alias("_last"))
    mine = mine.crossJoin(F.broadcast(span)).where(F.exists("times", lambda t: F.to_date(t).between(F.col("_first"), F.col("_last")))).drop("_first", "_last")
    there = mine.join(anchors, ["enid", "exid", "path_key"]).select("enid", "exid", "path_key", *keys, F.explode(F.array_distinct(F.filter(visits, lambda v: F.array_contains("anchors", v["unit"]) & v["hour"].isNotNull()))).alias("v"))
    hourly = there.groupBy("enid", "exid", "path_key", F.col("v.unit").alias("anchor"), F.col("v.hour").alias("hour"), *keys).agg(F.count("*").alias("n"))
    days = works.select("works_id", F.col("start").alias("_a"), F.col("end").alias("_b"), F.add_months("start", -12 * years).alias("_c"), F.add_months("end", -12 * years).alias("_d"))
    timed = wanted.select("works_id", "enid", "exid", "path_key", "anchor").join(days, "works_id").join(hourly, ["enid", "exid", "path_key", "anchor"])
    within = lambda a, b: F.to_date("hour").between(F.col(a), F.col(b))
    flows = timed.where(within("_a", "_b") | within("_c", "_d")).groupBy("works_id", "enid", "exid", "path_key", *keys).agg(period_sum("n", within("_a", "_b")).alias("con_flow"), period_sum("n", within("_c", "_d")).alias("sp_flow"))
    flows = stored(flows, "anchors-flows")
    types = flows.select("works_id", *keys).distinct()
    first = works.select("works_id").join(types, "works_id", "left")
    kinds = dict(flows.dtypes)
    first = first.select("works_id", *(F.coalesce(F.col(k), F.lit("0").cast(kinds[k])).alias(k) for k in keys)).distinct()
    # a path meets its flows of all types in one row, before it comes with every type
    path = ["works_id", "enid", "exid", "path_key"]
    of_path = flows.groupBy(*path).agg(F.collect_list(F.struct(*keys, "con_flow", "sp_flow")).alias("_flows"))
    every = wanted.drop("path").join(of_path, path, "left").join(first, "works_id")
    mine_of = F.get(F.filter("_flows", lambda f: reduce(and_, (f[k] == F.col(k) for k in keys), F.lit(True))), F.lit(0))
    every = every.withColumns({c: F.coalesce(mine_of[c], F.lit(0)).cast(kinds[c]) for c in ("con_flow", "sp_flow")}).drop("_flows")
    every = every.select(*path, *keys, *(c for c in every.columns if c not in (*path, *keys)))
    return every.where("not is_affected or con_flow > 0 or sp_flow > 0")
