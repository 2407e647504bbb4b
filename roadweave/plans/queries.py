"""Registered queries of the relational operators, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures, paths
from ..operators import flow, impact, mining, quality, toll, warehouse
from .adapters import table, timed_trips, trips, visits, with_

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(
    with_("trips") + " select enid, exid, count(*) as trip_count, sum(fee)::double as sum_value, sum(fee)::double / count(fee) as avg_value, min(fee)::double "
    "as min_value, max(fee)::double as max_value from trips group by all having count(*) >= 3"
)
def a1_od_path_stats(spark, sf_dir):
    return warehouse.od_path_stats(trips(spark, sf_dir), ["enid", "exid"], "fee", 3).withColumns({c: F.col(c).cast("double") for c in ("sum_value", "min_value", "max_value")})


_PCU = "case vehicle_type when 1 then 1.0 when 2 then 1.5 when 3 then 2.0 when 4 then 3.0 when 5 then 2.5 else 1.0 end::double"


@query(with_("trips") + f" select entime::date as stat_day, enid, exid, vehicle_type, count(*) as flow, sum({_PCU}) as flow_pcu from trips group by all")
def a2_od_daily_pcu(spark, sf_dir):
    return warehouse.daily_demand(trips(spark, sf_dir), ["enid", "exid"], F.to_date("entime"), "vehicle_type")


@query(
    with_("trips") + f" select u as section, entime::date as stat_day, vehicle_type, count(*) as flow, sum({_PCU}) as flow_pcu from (select distinct trip_id, "
    f"entime, vehicle_type, unnest(path) as u from trips) group by all"
)
def a3_section_daily(spark, sf_dir):
    each = trips(spark, sf_dir).select("entime", "vehicle_type", F.explode(F.array_distinct("path")).alias("section"))
    daily = warehouse.daily_demand(each, ["section"], F.to_date("entime"), "vehicle_type")
    return warehouse.roll_up(daily, ["section", "stat_day", "vehicle_type"], ["flow", "flow_pcu"])


@query(
    with_("trips")
    + """ select n_regionkey as scheme, coalesce(total_flow, 0)::bigint as total_flow, coalesce(od_pairs, 0) as od_pairs, coalesce(loss_fee, 0)::double as loss_fee,
        coalesce(gain_fee, 0)::double as gain_fee, coalesce((select count(*) from nation n where n.n_regionkey = s.n_regionkey), 0) as section_count
      from (select distinct n_regionkey from nation) s left join (
        select n_regionkey as k, count(*) as total_flow, count(distinct (enid, exid)) as od_pairs,
            sum(case when fee - 150000 < 0 then 150000 - fee else 0 end) as loss_fee, sum(case when fee - 150000 > 0 then fee - 150000 else 0 end) as gain_fee
        from trips join nation on enid = n_nationkey where n_regionkey <> 2 group by 1) on k = s.n_regionkey"""
)
def a6_scheme_summary(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("enid"), F.col("n_regionkey").alias("scheme"))
    results = trips(spark, sf_dir).join(nation, "enid").where("scheme <> 2").withColumns({"flow": F.lit(1), "fee_diff": F.col("fee") - 150000})
    found = warehouse.scheme_summary(results, nation, nation.select("scheme").distinct(), "scheme")
    return found.withColumns({c: F.col(c).cast("double") for c in ("loss_fee", "gain_fee")})


@query(
    with_("trips") + " select unit, stat_hour, vehicle_type, count(*) as flow_cnt from (select distinct trip_id, vehicle_type, path[i] as unit, date_trunc('hour', "
    "entime + to_minutes(40 * (i - 1))) as stat_hour from (select *, unnest(range(1, len(path) + 1)) as i from trips)) group by all"
)
def a4_hourly_flow(spark, sf_dir):
    return flow.hourly_flow(timed_trips(spark, sf_dir))


@query(with_("trips") + " select distinct unnest(path) as section, trip_id from trips")
def q_bridge_unnest(spark, sf_dir):
    return flow.bridge(trips(spark, sf_dir), "trip_id")


@query(with_("trips") + " select trip_id, enid, exid from trips where list_has_any(path, [3, 7, 11])")
def j7_bridge_semi(spark, sf_dir):
    t = trips(spark, sf_dir)
    return flow.paths_through(t, flow.bridge(t, "trip_id"), [3, 7, 11], "trip_id").select("trip_id", "enid", "exid")


@query(with_("trips") + " select trip_id, enid, exid from trips where list_has_any(path, [3, 7, 11])")
def j8_unnest_semi(spark, sf_dir):
    return flow.paths_overlapping(trips(spark, sf_dir), [3, 7, 11]).select("trip_id", "enid", "exid")


_FREQ = ", freq as (select enid, exid, vehicle_type, array_to_string(path, '|') as fixed, count(*) as ig_count from trips group by all)"


def _freq(spark, sf_dir):
    return flow.path_frequency(trips(spark, sf_dir).withColumn("fixed", paths.join_path(F.col("path"))), ["enid", "exid", "vehicle_type", "fixed"])


@query(with_("trips") + _FREQ + " select *, rank() over (partition by enid, exid, vehicle_type order by ig_count desc) as ig_rank from freq")
def w1_rank_freq(spark, sf_dir):
    return flow.ranked_frequency(_freq(spark, sf_dir), ["enid", "exid", "vehicle_type"], "fixed").drop("row_no")


@query(with_("trips") + _FREQ + """ select enid, exid, vehicle_type, fixed, ig_count, total::bigint as total_trip_cnt, round(ig_count::decimal(18, 0) / total, 4)::decimal(5, 4) as path_freq_ratio from (
    select *, sum(ig_count) over (partition by enid, exid, vehicle_type) as total, row_number() over (partition by enid, exid, vehicle_type order by ig_count desc, fixed) as n from freq) where n = 1""")
def m6_best_path_map(spark, sf_dir):
    return flow.best_path_map(_freq(spark, sf_dir), ["enid", "exid", "vehicle_type"], "fixed")


_WORKS = """works as (select n_nationkey as section, date '2024-01-01' + n_nationkey::int as start, date '2024-01-01' + n_nationkey::int + (n_nationkey % 9)::int as stop, n_nationkey % 4 + 1 as lanes, n_nationkey % 3 + 1 as open_lanes from nation),
    capacity as (select section, unnest(generate_series(start, stop, interval 1 day))::date as stat_day, open_lanes * 2000 as design_capacity, round(open_lanes * 2000 * (open_lanes / lanes))::int as capacity from works)"""


def _capacity(spark, sf_dir):
    n = F.col("n_nationkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    works = table(spark, sf_dir, "nation").select(n.alias("section"), start.alias("start"), F.date_add(start, (n % 9).cast("int")).alias("end"), (n % 4 + 1).alias("lanes"), (n % 3 + 1).alias("open_lanes"))
    rules = spark.range(1, 5).select(F.col("id").cast("int").alias("lanes"), (F.col("id") * 2000).cast("int").alias("capacity"))
    return warehouse.capacity_days(works, rules)


@query(f"with {_WORKS} select * from capacity")
def s15_capacity_days(spark, sf_dir):
    return _capacity(spark, sf_dir)


_RULES = "(values ('short cheap', 0.0, 300000.0, 0, 20, null, date '1992-01-01', null), ('long', 0.0, 300000.0, 20, 51, 1, date '1992-01-01', date '1995-12-31'), ('long late', 0.0, 300000.0, 20, 51, 1, date '1996-01-01', null), ('dear', 300000.0, 1e9, 0, 51, 2, date '1992-01-01', null)) r(rule_id, x_min, x_max, y_min, y_max, rule_type, valid_from, valid_to)"


@query(
    with_("trips") + f" select trip_id, rule_id from (select o_orderkey as trip_id, o_totalprice as fee, o_orderkey % 50 as mileage, substr(o_orderpriority, "
    f"1, 1)::int as kind, o_orderdate::date as day from orders) left join {_RULES} on fee >= x_min and fee < x_max and mileage >= y_min "
    f"and mileage < y_max and (rule_type is null or kind = rule_type) and day >= valid_from and (valid_to is null or day <= valid_to)"
)
def j3_range_rule_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_totalprice").alias("fee"), (F.col("o_orderkey") % 50).alias("mileage"), F.substring("o_orderpriority", 1, 1).cast("int").alias("kind"), F.to_date("o_orderdate").alias("day"))
    rules = spark.sql(f"select * from values ('short cheap', 0.0D, 300000.0D, 0, 20, cast(null as int), date '1992-01-01', cast(null as date)), ('long', 0.0D, 300000.0D, 20, 51, 1, date '1992-01-01', date '1995-12-31'), ('long late', 0.0D, 300000.0D, 20, 51, 1, date '1996-01-01', null), ('dear', 300000.0D, 1e9D, 0, 51, 2, date '1992-01-01', null) as r(rule_id, x_min, x_max, y_min, y_max, rule_type, valid_from, valid_to)")
    return warehouse.range_rules(o, rules, "fee", "mileage", "kind", "day").select("trip_id", "rule_id")


@query(
    "with m as (select distinct strftime(o_orderdate, '%Y%m') as month from orders) select month, coalesce((select max(v) from (values "
    "('199301'), ('199406'), ('199512'), ('199702')) x(v) where v <= month), '199001') as version from m"
)
def j5_asof_version(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"))
    return flow.asof_version(months, spark.createDataFrame([("199301",), ("199406",), ("199512",), ("199702",)], "version string"), default="199001")


@query(
    f"with {_WORKS}, demand as (select date '2024-01-01' + (o_orderkey % 40)::int as stat_day, sum(o_totalprice) / 1000 as flow from orders "
    f"group by 1) select c.section, c.stat_day, c.capacity, round(r, 6) as impact_ratio, round(flow * r)::int as impacted_flow, case when "
    f"r >= 0.5 then 'high' when r >= 0.2 then 'medium' when r > 0 then 'low' else 'none' end as level from (select *, case when capacity "
    f">= flow then 0 else least(1, (flow - capacity) / flow) end as r from (select section, stat_day, capacity, coalesce(flow, 0) as flow "
    f"from capacity left join demand using (stat_day))) c"
)
def p4_impact_ratio(spark, sf_dir):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 40).cast("int"))
    demand = table(spark, sf_dir, "orders").groupBy(day.alias("stat_day")).agg((F.sum("o_totalprice") / 1000).alias("flow"))
    found = warehouse.impacted_flow(_capacity(spark, sf_dir), demand, ["stat_day"])
    return found.select("section", "stat_day", "capacity", F.round("impact_ratio", 6).alias("impact_ratio"), "impacted_flow", "level")


_OD = "od as (select distinct a.event_type as enid, reverse(b.event_type) as exid from events a, (select distinct event_type from events) b where a.event_type < b.event_type)"


def _ods(spark, sf_dir):
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    return kinds.alias("a").join(kinds.alias("b"), F.col("a.event_type") < F.col("b.event_type")).select(F.col("a.event_type").alias("enid"), F.reverse("b.event_type").alias("exid"))


_MID = with_("visits") + f""", {_OD}, mine as (select * from visits where enid in (select enid from od) or exid in (select exid from od)),
    nxt as (select *, lead(event_id) over w as next_id, lead(enid) over w as next_enid, lead(exid) over w as next_exid, lead(entime) over w as next_entime from mine window w as (partition by vehicle order by entime, event_id)),
    mid as (select * from nxt where next_id is not null and next_entime >= extime and next_entime - extime <= interval 6 hours and exid <> next_enid and (enid, next_exid) in (select (enid, exid) from od))"""


@query(_MID + " select vehicle, event_id, next_id as next_event_id, enid, next_exid from mid")
def j13_mid_trip_exit(spark, sf_dir):
    return impact.mid_trip_exits(visits(spark, sf_dir), _ods(spark, sf_dir)).select("vehicle", "event_id", "next_event_id", "enid", "next_exid")


@query(_MID + " select event_id, vehicle, enid from visits where (vehicle, entime) not in (select (vehicle, entime) from mid)")
def j14_exclusion_anti(spark, sf_dir):
    v = visits(spark, sf_dir)
    return impact.without_used(v, impact.mid_trip_exits(v, _ods(spark, sf_dir))).select("event_id", "vehicle", "enid")


@query(
    with_("trips") + ", od(od_enid, od_exid) as (values (1, 4), (2, 9), (5, 6), (5, 9)), near(u) as (values (1), (5), (6)) select trip_id, od_enid, od_exid, "
    "'exit' as record_type from trips join od on exid = od_exid where od_enid in (select u from near) and enid <> od_enid union all select "
    "trip_id, od_enid, od_exid, 'entry' from trips join od on enid = od_enid where od_exid in (select u from near) and exid <> od_exid"
)
def j15_detour_union(spark, sf_dir):
    ods = spark.createDataFrame([(1, 4), (2, 9), (5, 6), (5, 9)], "enid int, exid int")
    near = spark.createDataFrame([(1,), (5,), (6,)], "unit int")
    return impact.detour_candidates(trips(spark, sf_dir), ods, near).select("trip_id", "od_enid", "od_exid", "record_type")


@query(
    with_("trips") + " select p.enid, p.exid, t.vehicle_type, (select count(*) from trips f where f.enid = p.enid and f.exid = p.exid and f.vehicle_type "
    "= t.vehicle_type) as flow from (select distinct enid, exid from trips) p, (select distinct vehicle_type from trips) t"
)
def j17_cross_types(spark, sf_dir):
    t = trips(spark, sf_dir).withColumn("od", F.struct("enid", "exid"))
    flows = t.groupBy("od", "vehicle_type").agg(F.count("*").alias("flow"))
    return impact.path_types(t.select("od").distinct(), t.select("vehicle_type"), flows, "od", "vehicle_type", "flow").select("od.enid", "od.exid", "vehicle_type", "flow")


_RAW = """, raw as (select enid, exid, vehicle_type, path, list_has_any(path, [3, 7]) as is_affected, max(fee) as fee, max(fee) * 0.5 as control_fee,
        count(*) filter (year(entime) = 1996) as flow, count(*) filter (year(entime) = 1995) as sp_flow, sum(1000 + 137 * len(path))::bigint as length, sum(137 * len(path))::bigint as control_length from trips group by all),
    flow1 as (select enid, exid, vehicle_type, coalesce(sum(fee) filter (is_affected)::double / nullif(count(fee) filter (is_affected), 0), 0) as con_fee, coalesce(sum(control_fee) filter (is_affected)::double / nullif(count(control_fee) filter (is_affected), 0), 0) as con_control_fee,
        coalesce(sum(flow) filter (is_affected), 0)::bigint as con_flow, coalesce(sum(sp_flow) filter (is_affected), 0)::bigint as con_sp_flow, coalesce(sum(length) filter (is_affected), 0)::bigint as con_length, coalesce(sum(control_length) filter (is_affected), 0)::bigint as con_control_length,
        coalesce(sum(fee) filter (not is_affected)::double / nullif(count(fee) filter (not is_affected), 0), 0) as other_fee, coalesce(sum(control_fee) filter (not is_affected)::double / nullif(count(control_fee) filter (not is_affected), 0), 0) as other_control_fee,
        coalesce(sum(flow) filter (not is_affected), 0)::bigint as other_flow, coalesce(sum(sp_flow) filter (not is_affected), 0)::bigint as other_sp_flow, coalesce(sum(length) filter (not is_affected), 0)::bigint as other_length, coalesce(sum(control_length) filter (not is_affected), 0)::bigint as other_control_length
        from raw group by 1, 2, 3 having con_sp_flow > 0),
    mid as (select enid, exid, vehicle_type, sum((year(entime) = 1996)::int)::double as mid_flow, sum((year(entime) = 1995)::int)::double as mid_sp_flow, sum(fee * 0.01)::double as mid_loss_fee, sum(fee * 0.005)::double as mid_control_loss_fee from trips where len(path) = 3 group by all),
    detour as (select enid, exid, vehicle_type, sum((year(entime) = 1996)::int)::double as detour_flow, sum((year(entime) = 1995)::int)::double as detour_sp_flow, sum(fee * 0.01)::double as detour_loss_fee, sum(fee * 0.005)::double as detour_control_loss_fee from trips where len(path) = 2 group by all),
    wide as (select flow1.*, coalesce(mid_flow, 0) as mid_flow, coalesce(mid_sp_flow, 0) as mid_sp_flow, coalesce(mid_control_loss_fee / nullif(mid_flow, 0), 0) as mid_unit, coalesce(detour_flow, 0) as detour_flow, coalesce(detour_sp_flow, 0) as detour_sp_flow, coalesce(detour_control_loss_fee / nullif(detour_flow, 0), 0) as detour_unit
        from flow1 left join mid using (enid, exid, vehicle_type) left join detour using (enid, exid, vehicle_type)),
    s1 as (select *, greatest(0, con_sp_flow - con_flow) as affected_flow from wide), s2 as (select *, least(greatest(0, other_flow - other_sp_flow), affected_flow) as detour_flow_final, detour_flow - detour_sp_flow as near_more, mid_flow - mid_sp_flow as mid_more from s1),
    s3 as (select *, case when near_more <= 0 or near_more + mid_more < 0 then 0 when near_more + mid_more > affected_flow - detour_flow_final then trunc(least(near_more, affected_flow - detour_flow_final))::int else trunc(near_more)::int end as retained_nearby from s2),
    s4 as (select *, affected_flow - detour_flow_final - retained_nearby as left2 from s3),
    s5 as (select *, case when mid_more <= 0 or left2 <= 0 then 0 when mid_more <= left2 then trunc(mid_more)::int else left2::int end as retained_midtrip from s4),
    summary as (select enid, exid, vehicle_type, con_sp_flow as ref_total_flow, con_flow as unaffected_flow, affected_flow, detour_flow_final, retained_nearby, retained_midtrip, left2 - retained_midtrip as lost_flow,
        con_sp_flow * con_control_fee / 10000 as original_control_fee, con_flow * con_control_fee / 10000 as unaffected_control_fee, detour_flow_final * other_control_fee / 10000 as detour_control_fee_final,
        retained_nearby * detour_unit / 10000 as retained_nearby_control_fee, retained_midtrip * mid_unit / 10000 as retained_midtrip_control_fee, (left2 - retained_midtrip) * con_control_fee / 10000 as lost_control_fee from s5)"""
_KEYS = ["enid", "exid", "vehicle_type"]


def _raw(spark, sf_dir):
    in_year = lambda y: F.count(F.when(F.year("entime") == y, 1))
    t = trips(spark, sf_dir).withColumn("is_affected", F.arrays_overlap("path", F.array(F.lit(3), F.lit(7))))
    found = t.groupBy(*_KEYS, "path", "is_affected").agg(F.max("fee").alias("fee"), in_year(1996).alias("flow"), in_year(1995).alias("sp_flow"), F.sum(1000 + 137 * F.size("path")).alias("length"), F.sum(137 * F.size("path")).alias("control_length"))
    return found.withColumn("control_fee", F.expr("fee * 0.5"))


def _losses(spark, sf_dir, size, name):
    rows = trips(spark, sf_dir).where(F.size("path") == size)
    year = lambda y: (F.year("entime") == y).cast("double")
    return impact.flow_losses(rows.select(*_KEYS, year(1996).alias("flow"), year(1995).alias("sp_flow"), F.expr("fee * 0.01").alias("loss_fee"), F.expr("fee * 0.005").alias("control_loss_fee")), _KEYS, name)


def _summary(spark, sf_dir):
    return impact.impact_summary(impact.flow1(_raw(spark, sf_dir), _KEYS), _losses(spark, sf_dir, 3, "mid"), _losses(spark, sf_dir, 2, "detour"), _KEYS)


@query(with_("trips") + _RAW + " select * from flow1")
def a8_impact_pivot(spark, sf_dir):
    return impact.flow1(_raw(spark, sf_dir), _KEYS)


_FEES = [m for m in measures.MEASURES if m.endswith(("fee", "final")) and "control" in m]
_ROUNDED = ", ".join(f"round({m}, 8) as {m}" if m in _FEES else f"{m}::double as {m}" for m in measures.MEASURES)


def _rounded(df, *keys):
    return df.select(*keys, *(F.round(m, 8).alias(m) if m in _FEES else F.col(m).cast("double").alias(m) for m in measures.MEASURES))


@query(with_("trips") + _RAW + f" select enid, exid, vehicle_type, {_ROUNDED} from summary")
def f6_impact_derive(spark, sf_dir):
    return _rounded(_summary(spark, sf_dir), *_KEYS)


@query(with_("trips") + _RAW + " select enid, exid, vehicle_type, retained_nearby, retained_midtrip from summary where retained_nearby + retained_midtrip > 0")
def f7_retained(spark, sf_dir):
    return _summary(spark, sf_dir).where("retained_nearby + retained_midtrip > 0").select(*_KEYS, "retained_nearby", "retained_midtrip")


@query(with_("trips") + _RAW + f", total as (select enid, exid, {', '.join(f'sum({m}) as {m}' for m in measures.MEASURES)} from summary group by all) select enid, exid, {_ROUNDED} from total")
def a10_rollups(spark, sf_dir):
    return _rounded(impact.measure_roll_up(_summary(spark, sf_dir), ["enid", "exid"]), "enid", "exid")


@query(
    with_("trips") + ", od(od_enid, od_exid) as (values (1, 4), (2, 4), (5, 4), (5, 9)), rec as (select enid, exid, vehicle_type, od_enid, od_exid from "
    "trips join od on exid = od_exid), n as (select enid, exid, vehicle_type, count(distinct (od_enid, od_exid)) as od_count from rec group "
    "by all) select r.enid, r.exid, r.vehicle_type, od_enid, od_exid, any_value(od_count) as od_count, count(*) / any_value(od_count) as "
    "flow from rec r join n using (enid, exid, vehicle_type) group by r.enid, r.exid, r.vehicle_type, od_enid, od_exid"
)
def a11_flow_averaging(spark, sf_dir):
    ods = spark.createDataFrame([(1, 4), (2, 4), (5, 4), (5, 9)], "od_enid int, od_exid int")
    t = trips(spark, sf_dir)
    rows = t.join(ods, t["exid"] == ods["od_exid"]).withColumn("flow", F.lit(1.0))
    return impact.shared_flow(rows, _KEYS, ["od_enid", "od_exid"], "flow")


@query(with_("trips") + " select enid, exid, vehicle, vehicle_type, count(*) as freq from trips group by all order by freq desc, enid, exid, vehicle, vehicle_type limit 200")
def a13_vehicle_freq(spark, sf_dir):
    return mining.vehicle_frequency(trips(spark, sf_dir), top=200)


@query(with_("trips") + " select enid, exid, vehicle_type, count(*) as trip_cnt, count(distinct vehicle) as vehicles from trips where (enid, exid) in ((1, 4), (2, 9), (3, 3), (7, 8)) group by all")
def a14_plate_stats(spark, sf_dir):
    ods = spark.createDataFrame([(1, 4), (2, 9), (3, 3), (7, 8)], "enid int, exid int")
    return trips(spark, sf_dir).join(F.broadcast(ods), ["enid", "exid"]).groupBy("enid", "exid", "vehicle_type").agg(F.count("*").alias("trip_cnt"), F.countDistinct("vehicle").alias("vehicles"))


@query(with_("trips") + """, flows as (select enid, exid, array_to_string(path, '|') as fixed, count(*) as flow from trips group by all), run as (select *, coalesce(sum(flow) over (partition by enid, exid order by flow, fixed rows between unbounded preceding and 1 preceding), 0) as before from flows)
    select enid, exid, fixed, flow, greatest(0, least(flow, 5 + enid - before))::bigint as allocated from run where greatest(0, least(flow, 5 + enid - before)) > 0""")
def a15_greedy_prefix(spark, sf_dir):
    t = trips(spark, sf_dir)
    flows = t.withColumn("fixed", paths.join_path(F.col("path"))).groupBy("enid", "exid", "fixed").agg(F.count("*").alias("flow"))
    wanted = t.select("enid", "exid", (F.col("enid") + 5).alias("flow_x")).distinct()
    return mining.greedy_prefix(flows, wanted, ["enid", "exid"], "flow", "fixed").drop("flow_x")


@query(
    with_("trips") + " select u as section, count(*) as flow from (select unnest(path) as u, enid, exid from trips where not list_has_any(path, [3, 7]) "
    "and concat(least(enid, exid), '|', greatest(enid, exid)) in ('1|4', '2|9', '5|6')) where u <> enid and u <> exid group by all"
)
def a16_numpath_flow(spark, sf_dir):
    wanted = spark.createDataFrame([("1|4",), ("2|9",), ("5|6",)], "od string")
    mine = trips(spark, sf_dir).withColumn("od", mining.unordered_key("enid", "exid")).join(F.broadcast(wanted), "od", "left_semi")
    mine = mine.where(~F.arrays_overlap("path", F.array(F.lit(3), F.lit(7)))).withColumn("flow", F.lit(1))
    return mining.section_flow(mine, "path", "flow", skip=["enid", "exid"])


@query(with_("trips") + _RAW + " select enid, " + ", ".join(f"coalesce(sum(lost_flow) filter (vehicle_type = {i}), 0)::bigint as v{i}" for i in range(1, 6)) + " from summary group by all")
def a18_loss_matrix(spark, sf_dir):
    return impact.loss_matrix(_summary(spark, sf_dir), "enid", "vehicle_type", [1, 2, 3, 4, 5], "lost_flow")


_TYPES = ", t as (select enid, vehicle_type, sum(lost_flow) as lost, sum(affected_flow) as affected, sum(lost_control_fee) as fee from summary group by all), best as (select *, row_number() over (partition by enid order by lost desc, vehicle_type) as n1, row_number() over (partition by enid order by coalesce(lost / nullif(affected, 0), -1) desc, vehicle_type) as n2 from t)"


@query(with_("trips") + _RAW + _TYPES + " select enid, vehicle_type as main_type from best where n1 = 1")
def a19_argmax_type(spark, sf_dir):
    return impact.evaluation(_summary(spark, sf_dir), "enid", "vehicle_type").select("enid", "main_type")


@query(
    with_("trips") + _RAW + _TYPES + " select enid, sum(lost)::bigint as lost_flow, round(sum(fee), 8) as lost_fee, max(vehicle_type) filter (n1 = 1) as main_type, max(vehicle_type) "
    "filter (n2 = 1) as highest_rate_type from best group by all"
)
def a20_evaluation(spark, sf_dir):
    return impact.evaluation(_summary(spark, sf_dir), "enid", "vehicle_type").withColumn("lost_fee", F.round("lost_fee", 8))


@query(
    with_("trips") + _RAW + " select enid, sum(lost_flow)::bigint as lost_flow, sum(affected_flow)::bigint as affected_flow, round(sum(lost_flow) * 100.0 / nullif(sum(affected_flow), "
    "0), 1)::double as loss_rate from summary group by all order by lost_flow desc, enid limit 15"
)
def l1_top15(spark, sf_dir):
    return impact.top_losses(_summary(spark, sf_dir), "enid")


@query(with_("trips") + " select trip_id, array_to_string(list_filter(path, lambda x, i: i = 1 or x <> path[i - 1]), '|') as deduped from trips")
def q_adjacent_dedup(spark, sf_dir):
    return trips(spark, sf_dir).select("trip_id", paths.join_path(paths.adjacent_dedup(F.col("path"))).alias("deduped"))


@query(with_("trips") + " select trip_id from trips where list_position(path, 3) > 0 and list_position(list_reverse(path), 7) > 0 and list_position(path, 3) < len(path) + 1 - list_position(list_reverse(path), 7)")
def q_ordered_pair(spark, sf_dir):
    return trips(spark, sf_dir).where(paths.visits_in_order(F.col("path"), F.lit(3), F.lit(7))).select("trip_id")


@query(
    with_("trips") + ", h as (select trip_id, list_filter(path, lambda x: x in (3, 7, 11)) as hit from trips) select trip_id, hit[1] as first_hit, hit[-1] "
    "as last_hit, len(hit)::int as n_hits from h where len(hit) > 0"
)
def q_hit_first_last(spark, sf_dir):
    hit = paths.hits(F.col("path"), F.array(F.lit(3), F.lit(7), F.lit(11)))
    return trips(spark, sf_dir).select("trip_id", hit.alias("hit")).where(F.size("hit") > 0).select("trip_id", F.get("hit", F.lit(0)).alias("first_hit"), F.element_at("hit", -1).alias("last_hit"), F.size("hit").alias("n_hits"))


@query(with_("trips") + " select least(enid, exid) || '|' || greatest(enid, exid) as section_od, count(*) as trips from trips group by 1")
def q_endpoints_od(spark, sf_dir):
    return trips(spark, sf_dir).groupBy(paths.endpoints_key(F.col("path")).alias("section_od")).agg(F.count("*").alias("trips"))


@query("""with w as (select p_partkey, list_filter(string_split(replace(p_type, ' ', '-') || '-' || replace(p_type, ' ', '-') || '-' || p_brand, '-'), lambda x: x <> '') as words from part),
    r as (select *, list_filter(words, lambda x: len(list_filter(words, lambda y: y = x)) < 2) as rare from w), k as (select p_partkey, case when len(rare) > 0 then rare else words end as kept from r)
    select p_partkey, array_to_string(list_filter(kept, lambda x, i: list_position(kept, x) = i), '-') as name from k""")
def q_name_dedup(spark, sf_dir):
    text = F.concat_ws("-", F.replace("p_type", F.lit(" "), F.lit("-")), F.replace("p_type", F.lit(" "), F.lit("-")), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", paths.interval_name(text, 2).alias("name"))


@query()
def q_num_pair_dedup(spark, sf_dir):
    """Distinct paths without repeated pairs."""
    distinct = trips(spark, sf_dir).select("path").distinct()
    return distinct.select(paths.join_path(F.col("path")).alias("path"), paths.join_path(paths.pair_dedup_udf()(F.col("path"))).alias("numpath"))


_UNITS = "units as (select n_nationkey as unit, 1000 + 137 * n_nationkey as length, n_nationkey % 3 + 1 as roadtype, n_nationkey % 4 + 1 as fk, n_nationkey % 2 + 1 as fh, n_nationkey % 5 = 0 as is_control from nation), rates as (select r as roadtype, f as feetype, v as vehicle_type, (r * 10 + f + v) / 100.0::double as feebykm from range(1, 3) a(r), range(1, 5) b(f), range(1, 6) c(v) where not (f = 4 and v = 5))"
_FEE = "fees as (select trip_id, t.vehicle_type, round(coalesce(sum(case when u.roadtype in (1, 2) then feebykm * length / 1000.0 end), 0), 6) as fee, coalesce(sum(length), 0)::bigint as length_m, round(coalesce(sum(case when u.roadtype in (1, 2) and is_control then feebykm * length / 1000.0 end), 0), 6) as control_fee, coalesce(sum(length) filter (is_control), 0)::bigint as control_length_m from (select trip_id, vehicle_type, unnest(path) as unit from {src}) t left join units u using (unit) left join rates r on u.roadtype = r.roadtype and r.vehicle_type = t.vehicle_type and r.feetype = case when t.vehicle_type between 1 and 4 then fk else fh end group by all)"


def _units(spark, sf_dir):
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(n.alias("unit"), (1000 + 137 * n).alias("length"), (n % 3 + 1).alias("roadtype"), (n % 4 + 1).alias("feektype"), (n % 2 + 1).alias("feehtype"), (n % 5 == 0).alias("is_control"))


def _rates(spark):
    one = lambda a, b, name: spark.range(a, b).select(F.col("id").cast("int").alias(name))
    found = one(1, 3, "roadtype").crossJoin(one(1, 5, "feetype")).crossJoin(one(1, 6, "vehicle_type")).where("not (feetype = 4 and vehicle_type = 5)")
    return found.withColumn("feebykm", (F.col("roadtype") * 10 + F.col("feetype") + F.col("vehicle_type")) / 100.0)


def _fees(df):
    return df.withColumns({c: F.round(c, 6) for c in ("fee", "control_fee")})


@query(with_("trips") + f", {_UNITS}, {_FEE.format(src='trips')} select * from fees")
def a23_path_fee(spark, sf_dir):
    return _fees(toll.path_fees(trips(spark, sf_dir), _units(spark, sf_dir), _rates(spark), "trip_id"))


@query(with_("trips") + f", {_UNITS}, few as (select trip_id, path, unnest(range(1, 6))::int as vehicle_type from trips), {_FEE.format(src='few')} select * from fees")
def f5_fee_all_types(spark, sf_dir):
    return _fees(toll.fees_by_type(trips(spark, sf_dir).select("trip_id", "path"), _units(spark, sf_dir), _rates(spark), "trip_id"))


@query(
    with_("trips") + ", x as (select trip_id, (len(path) - len(list_distinct(path))) / len(path) as increase from trips) select trip_id, round(increase, "
    "6) as increase, case when increase < 0.1 then 0.5 when increase < 0.2 then 0.4 when increase < 0.3 then 0.3 when increase < 0.5 then "
    "0.2 else 0 end::double as ratio from x"
)
def j4_detour_ratio(spark, sf_dir):
    increase = (F.size("path") - F.size(F.array_distinct("path"))) / F.size("path")
    return trips(spark, sf_dir).select("trip_id", F.round(increase, 6).alias("increase"), measures.detour_band(increase).alias("ratio"))


_REV = "(select count(*) from range(1, len(path)) a(i) where exists (select 1 from range(1, len(path)) b(j) where j < i and path[j] = path[i + 1] and path[j + 1] = path[i]))"


@query(with_("trips") + f" select trip_id, (select count(*) from (select x from unnest(path) u(x) group by x having count(*) > 1))::int as repeated, {_REV}::int as reverse from trips")
def r10_repeat_reverse(spark, sf_dir):
    return trips(spark, sf_dir).select("trip_id", measures.repeated_nodes(F.col("path")).alias("repeated"), measures.reverse_edges(F.col("path")).alias("reverse"))


_GEO = ", pts as (select trip_id, p, 100 + (path[p] * 7) % 13 as lon, 30 + (path[p] * 5) % 11 as lat from (select trip_id, path, unnest(range(1, len(path) + 1)) as p from trips)), leg as (select *, lead(lon) over w as lon2, lead(lat) over w as lat2 from pts window w as (partition by trip_id order by p)), dir as (select trip_id, p, (degrees(atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)), cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon)))) + 360) % 360 as b from leg where lon2 is not null), turn as (select *, lead(b) over (partition by trip_id order by p) as b2 from dir)"


@query(with_("trips") + _GEO + " select trip_id, count(*) as u_turns from turn where b2 is not null and least(abs(b - b2) % 360, 360 - abs(b - b2) % 360) >= 150 group by 1")
def r12_uturn(spark, sf_dir):
    lon, lat = (lambda u: 100 + (u * 7) % 13), (lambda u: 30 + (u * 5) % 11)
    legs = F.transform(paths.neighbours(F.col("path"), 2), lambda n: measures.bearing(lon(n["0"]), lat(n["0"]), lon(n["1"]), lat(n["1"])))
    turns = F.size(F.filter(paths.neighbours(legs, 2), lambda n: measures.angle_between(n["0"], n["1"]) >= 150))
    return trips(spark, sf_dir).where(F.size("path") > 2).select("trip_id", turns.cast("bigint").alias("u_turns")).where("u_turns > 0")


def _even1(x: str) -> str:
    """One decimal, halves to even, of what six decimals say."""
    d = f"(round({x}, 6)::decimal(12, 6) * 10)"
    return f"((floor({d}) + case when {d} - floor({d}) > 0.5 or ({d} - floor({d}) = 0.5 and floor({d})::bigint % 2 = 1) then 1 else 0 end)::double / 10)"


_SCORE = f", m as (select trip_id, len(path) as n, (select count(*) from (select x from unnest(path) u(x) group by x having count(*) > 1)) as rep, {_REV} as rev, 1 + (trip_id % 17) / 10.0::double as ratio from trips), b as (select *, 30.0 * least(rev / 2.0, 1.0) + 25.0 * least((trip_id % 4) / 3.0, 1.0) + 20.0 * least(rep / 3.0, 1.0) + 10.0 * least(greatest(ratio - 1.2, 0.0), 1.0) as raw from m)"


def _scored(spark, sf_dir):
    path = F.col("path")
    t = trips(spark, sf_dir).select("trip_id", F.size(path).alias("n"), measures.repeated_nodes(path).alias("rep"), measures.reverse_edges(path).alias("rev"), (1 + (F.col("trip_id") % 17) / 10.0).alias("ratio"))
    t = t.withColumn("bti", measures.backtrack_index(F.col("rev"), F.col("trip_id") % 4, F.col("rep"), F.lit(0), F.col("ratio")))
    return t.withColumn("confidence", measures.repair_confidence(F.col("rep"), F.col("rev"), F.col("n"), F.col("ratio"), F.col("bti"), F.lit(1), F.col("n")))


@query(with_("trips") + _SCORE + f" select trip_id, {_even1('least(raw, 100.0)')} as bti from b")
def r14_bti(spark, sf_dir):
    return _scored(spark, sf_dir).select("trip_id", "bti")


_CONF = f", bt as (select *, {_even1('least(raw, 100.0)')} as bti from b), c0 as (select trip_id, greatest(least(100.0 - rep / n * 25.0 - rev / n * 15.0 - greatest(ratio - 1.2, 0.0) * 30.0 - bti * 0.5 - case when 1 < n * 0.3 then 10.0 else 0 end, 100.0), 0.0)::double as score from bt), c as (select trip_id, {_even1('score')} as confidence from c0)"


@query(with_("trips") + _SCORE + _CONF + " select trip_id, confidence from c")
def r15_confidence(spark, sf_dir):
    return _scored(spark, sf_dir).select("trip_id", "confidence")


@query(
    with_("trips") + _SCORE + _CONF + " select case when confidence >= 85 then 'HIGH_CONFIDENCE' when confidence >= 65 then 'MEDIUM_CONFIDENCE' when confidence >= 40 then "
    "'LOW_CONFIDENCE' else 'NEED_MANUAL_REVIEW' end as status, count(*) as n from c group by 1"
)
def r16_status(spark, sf_dir):
    return _scored(spark, sf_dir).groupBy(measures.repair_status(F.col("confidence")).alias("status")).agg(F.count("*").alias("n"))


@query(
    "select 'text' as column_name, count(*) filter (text is null) as nulls from documents union all select 'lang', count(*) filter (lang "
    "is null) from documents union all select 'source', count(*) filter (source is null) from documents"
)
def dq1_nulls(spark, sf_dir):
    return quality.null_counts(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def dq2_duplicates(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, 'l_quantity' as column_name from lineitem where l_quantity > 45 union all select l_orderkey, 'l_discount' from lineitem where l_discount < 0.01 or l_discount > 0.09")
def dq3_ranges(spark, sf_dir):
    return quality.out_of_range(table(spark, sf_dir, "lineitem"), {"l_quantity": (None, F.lit(45)), "l_discount": (F.lit(0.01), F.lit(0.09))}, "l_orderkey")


@query(
    "with s as (select l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) as total from lineitem group by 1) select o_orderkey, "
    "round(o_totalprice, 2) as o_totalprice from orders left join s on o_orderkey = l_orderkey where abs(o_totalprice - coalesce(total, "
    "0)) > 100000"
)
def dq4_recompute(spark, sf_dir):
    total = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total"))
    both = table(spark, sf_dir, "orders").join(total, "o_orderkey", "left")
    return quality.recomputed(both, F.col("o_totalprice"), F.coalesce("total", F.lit(0.0)), 100000).select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query(
    "with d as (select distinct user_id, ts::date as day from events), l as (select *, lag(day) over (partition by user_id order by day) "
    "as previous_day from d) select user_id, day, previous_day, (day - previous_day)::int as gap_days from l where day - previous_day > "
    "1"
)
def dq5_gaps(spark, sf_dir):
    return quality.day_gaps(table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query(
    "with a as (select user_id, count(*) as n from events group by 1), b as (select c_custkey as user_id, c_nationkey::bigint as n from "
    "customer) select coalesce(a.user_id, b.user_id) as user_id, coalesce(a.n, 0) as left_value, coalesce(b.n, 0) as right_value from a "
    "full join b on a.user_id = b.user_id where abs(coalesce(a.n, 0) - coalesce(b.n, 0)) > 5"
)
def dq7_recount(spark, sf_dir):
    a = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("n"))
    return quality.differing_counts(a, b, ["user_id"], "n", 5)


@query(
    "with new as (select event_type as k, max(ts) as last_ts, count(*) as n from events where event_id % 2 = 0 group by 1), old as (select "
    "event_type as k, max(ts) as last_ts, count(*) as n from events where event_id % 2 = 1 or event_type < 'd' group by 1) select k, n, "
    "last_ts from (select *, row_number() over (partition by k order by last_ts desc, fresh desc) as r from (select *, 1 as fresh from "
    "new union all select *, 0 from old)) where r = 1"
)
def k1_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    part = lambda rows: rows.groupBy(F.col("event_type").alias("k")).agg(F.max("ts").alias("last_ts"), F.count("*").alias("n"))
    return warehouse.upsert(part(e.where("event_id % 2 = 1 or event_type < 'd'")), part(e.where("event_id % 2 = 0")), ["k"], "last_ts")


@query("with f as (select user_id, date_trunc('hour', ts) as stat_hour, event_id % 2 as half from events) select user_id, stat_hour, count(*) as flow_cnt from f group by all")
def k2_accumulate(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("stat_hour", F.date_trunc("hour", "ts"))
    part = lambda half: e.where(F.col("event_id") % 2 == half).groupBy("user_id", "stat_hour").agg(F.count("*").alias("flow_cnt"))
    return warehouse.accumulate(part(0), part(1), ["user_id", "stat_hour"], ["flow_cnt"])


@query("select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def k3_insert_missing(spark, sf_dir):
    old = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return warehouse.insert_missing(old, table(spark, sf_dir, "orders").select("o_custkey"), ["o_custkey"])


@query("select event_id, case when user_id % 3 = 0 and event_type < 'd' then 'nearby,front' when user_id % 3 = 0 then 'nearby' when event_type < 'd' then 'front' else '' end as tags from events")
def j23_tagging(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    nearby = e.where("user_id % 3 = 0").select("user_id")
    front = e.where("event_type < 'd'").select("user_id", "event_type")
    return mining.tagged(e, {"nearby": (nearby, ["user_id"]), "front": (front, ["user_id", "event_type"])}).select("event_id", "tags")

