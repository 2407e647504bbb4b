"""Registered queries of calendar and lookup operators with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import dates, measures
from ..operators import lookup, numbering
from ..shared import stored
from ..sources import sinks
from .adapters import SQL, edges, table, timed_trips, trips, with_
from .queries import query


@query(
    "select o_orderkey, date_trunc('week', d)::date as week_first, (date_trunc('week', d) + interval 6 days)::date as week_last, date_trunc('quarter', "
    "d)::date as quarter_first, last_day(date_trunc('quarter', d)::date + interval 2 months) as quarter_last, (d - interval 12 months)::date "
    "as same_period from (select o_orderkey, o_orderdate::date as d from orders)"
)
def f9_calendar(spark, sf_dir):
    d = F.to_date("o_orderdate")
    (w1, w2), (q1, q2) = dates.week_range(d), dates.quarter_range(d)
    return table(spark, sf_dir, "orders").select("o_orderkey", w1.alias("week_first"), w2.alias("week_last"), q1.alias("quarter_first"), q2.alias("quarter_last"), measures.same_period(d).alias("same_period"))


@query(
    "select c_custkey, unnest(list_transform(generate_series(date_trunc('month', a), date_trunc('month', b), interval 1 month), lambda "
    "m: strftime(m, '%Y%m'))) as month from (select o_custkey as c_custkey, min(o_orderdate) as a, max(o_orderdate) as b from orders group "
    "by 1)"
)
def f10_month_list(spark, sf_dir):
    spans = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return spans.select("c_custkey", F.explode(dates.month_list(F.to_date("a"), F.to_date("b"))).alias("month"))


@query(
    "with c as (select o_custkey as k, list(distinct o_orderpriority order by o_orderpriority) as members from orders group by 1), p as "
    "(select o_orderstatus as k, list(distinct o_orderpriority order by o_orderpriority) as members from orders group by 1) select c.k "
    "as left_id, p.k as right_id from c join p on c.members = p.members"
)
def j24_same_sets(spark, sf_dir):
    """Customers whose orders have just the priorities that orders of a status have."""
    o = table(spark, sf_dir, "orders")
    left, right = o.select(F.col("o_custkey").alias("left_id"), "o_orderpriority"), o.select(F.col("o_orderstatus").alias("right_id"), "o_orderpriority")
    return lookup.same_sets(left, right, "left_id", "right_id", ["o_orderpriority"])


@query(
    "select c_custkey, coalesce((select min(s_suppkey) from supplier where s_nationkey = c_nationkey and s_acctbal > 8000), (select min(s_suppkey) "
    "from supplier where s_nationkey = c_nationkey)) as supplier from customer"
)
def j22_first_of(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return lookup.first_of(table(spark, sf_dir, "customer"), "c_nationkey", [(s.where("s_acctbal > 8000"), "s_nationkey", "s_suppkey"), (s, "s_nationkey", "s_suppkey")], "supplier").select("c_custkey", "supplier")


@query(f"with {SQL['edges']} select src as node from edges union select dst from edges")
def u2_vertices(spark, sf_dir):
    return lookup.vertices(edges(spark, sf_dir)).select("node")


@query(f"with {SQL['edges']} select src, array_to_string(list(distinct dst order by dst), '|') as next from edges group by 1")
def a25_adjacency(spark, sf_dir):
    return lookup.adjacency(edges(spark, sf_dir)).select("src", F.array_join(F.col("next").cast("array<string>"), "|").alias("next"))


@query(with_("trips") + " select depth, n, sum(n) over (order by depth)::bigint as reached from (select len(path)::int as depth, count(*) as n from trips group by len(path))")
def w4_cumulative(spark, sf_dir):
    n = trips(spark, sf_dir).groupBy(F.size("path").alias("depth")).agg(F.count("*").alias("n"))
    return numbering.running_sums(n, ["depth"], {"reached": "n"})


@query("select greatest(date '1993-02-01', least(date '1997-10-15', o_orderdate::date)) as stat_day, count(*) as n from orders group by 1")
def k9_clamped_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(sinks.clamped_day(F.col("o_orderdate"), "1993-02-01", "1997-10-15").alias("stat_day")).agg(F.count("*").alias("n"))


@query("select event_id from events where ts::date between date '2024-01-05' and date '2024-01-09'")
def k11_between_days(spark, sf_dir):
    return sinks.between_days(table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-09").select("event_id")


@query("select o_orderkey, o_totalprice from orders order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_totalprice desc, o_orderkey limit 100")
def l4_severity_top(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return table(spark, sf_dir, "orders").orderBy(rank, F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("select s.s_suppkey from supplier s where not exists (select 1 from lineitem where l_suppkey = s_suppkey and l_quantity > 49)")
def j16_orphans(spark, sf_dir):
    from ..operators.quality import orphans

    used = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return orphans(table(spark, sf_dir, "supplier"), used, ["s_suppkey"]).select("s_suppkey")


@query(
    "select o_orderkey, coalesce(nullif(trim(case when o_orderkey % 5 = 0 then '  ' else substr(o_orderpriority, 1, 1) end), ''), '0') "
    "as vehicle_type, coalesce(nullif(trim(case when o_orderkey % 5 = 0 then '  ' else substr(o_orderpriority, 1, 1) end), ''), '0')::int "
    "between 1 and 4 as passenger from orders"
)
def p10_vehicle_type(spark, sf_dir):
    kind = measures.vehicle_type(F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.substring("o_orderpriority", 1, 1)))
    return table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("vehicle_type"), measures.is_passenger(kind).alias("passenger"))


@query("select n_nationkey, case when coalesce(nullif(n_nationkey % 4, 3), 1) >= 2 then 'high' when coalesce(nullif(n_nationkey % 4, 3), 1) = 1 then 'medium' else 'low' end as level from nation")
def p2_lane_level(spark, sf_dir):
    from ..operators.warehouse import lane_level

    lanes = F.nullif(F.col("n_nationkey") % 4, F.lit(3))
    return table(spark, sf_dir, "nation").select("n_nationkey", lane_level(lanes).alias("level"))


@query(
    with_("trips") + " select trip_id, array_to_string(list_filter(list_transform(range(1, len(s) + 1), lambda i: case when i = 1 or s[i] <> s[i - 1] then "
    "s[i] end), lambda x: x is not null), '|') as sections from (select trip_id, list_filter(list_transform(path, lambda u: case when u "
    "% 6 <> 5 then u // 3 end), lambda x: x is not null) as s from trips) where len(s) > 0"
)
def a24_section_path(spark, sf_dir):
    from ..functions.paths import join_path
    from ..operators.flow import section_path

    sections = table(spark, sf_dir, "nation").where("n_nationkey % 6 <> 5").select(F.col("n_nationkey").alias("unit"), F.floor(F.col("n_nationkey") / 3).cast("int").alias("section"))
    return section_path(trips(spark, sf_dir), sections, "trip_id").select("trip_id", join_path(F.col("sections")).alias("sections"))


@query(with_("trips") + " select count(*) as ods, count(distinct (enid, exid)) as keys from (select distinct enid, exid from trips)")
def k4_surrogate_keys(spark, sf_dir):
    from ..operators.flow import od_key

    ods = trips(spark, sf_dir).select("enid", "exid").distinct()
    return ods.agg(F.count("*").alias("ods"), F.countDistinct(od_key("enid", "exid")).alias("keys"))


_PERIOD = "flows as (select enid, exid, vehicle_type, list_has_any(path, [3, 7]) as is_affected, count(*) filter (entime >= timestamp '1996-01-01' and entime < timestamp '1997-01-01') as con_flow, count(*) filter (entime >= timestamp '1995-01-01' and entime < timestamp '1996-01-01') as sp_flow from trips group by all)"


def _period_flows(spark, sf_dir):
    """Trips over [start, end) of the works' period and of the same one a year before, by pair, type and whether the works are met."""
    from ..operators.impact import period_sum

    within = lambda first, last: (F.col("entime") >= F.to_timestamp(F.lit(first)).cast("timestamp_ntz")) & (F.col("entime") < F.to_timestamp(F.lit(last)).cast("timestamp_ntz"))
    t = trips(spark, sf_dir).withColumns({"is_affected": F.arrays_overlap("path", F.array(F.lit(3), F.lit(7)).cast("array<int>")), "one": F.lit(1)})
    return t.groupBy("enid", "exid", "vehicle_type", "is_affected").agg(period_sum("one", within("1996-01-01", "1997-01-01")).alias("con_flow"), period_sum("one", within("1995-01-01", "1996-01-01")).alias("sp_flow"))


@query(with_("trips") + f", {_PERIOD} select * from flows")
def a7_period_flow(spark, sf_dir):
    """Flow by entry time; a7_anchor_flow has that at the anchor."""
    return _period_flows(spark, sf_dir)


@query(with_("trips") + f", {_PERIOD} select * from flows where not is_affected or con_flow > 2 or sp_flow > 2")
def p15_keep_affected(spark, sf_dir):
    from ..operators.impact import keep_affected

    return keep_affected(_period_flows(spark, sf_dir), 2)


@query(
    "select n_nationkey, round(2 * 6371000.0 * asin(sqrt(sin(radians(n_nationkey % 11) / 2) ** 2 + cos(radians(30)) * cos(radians(30 + "
    "n_nationkey % 11)) * sin(radians(n_nationkey % 13) / 2) ** 2)), 3) as metres, 'POINT(' || (100 + n_nationkey % 13) || ' ' || (30 + "
    "n_nationkey % 11) || ')' as point from nation"
)
def f13_geo(spark, sf_dir):
    lon, lat = F.col("n_nationkey") % 13 + 100, F.col("n_nationkey") % 11 + 30
    return table(spark, sf_dir, "nation").select("n_nationkey", F.round(measures.haversine_m(F.lit(100), F.lit(30), lon, lat), 3).alias("metres"), measures.wkt_point(lon, lat).alias("point"))


@query(
    f"with recursive {SQL['edges']}, hop(node, level, back) as (select n_nationkey, 0, b from nation, (values (true), (false)) t(b) where "
    f"n_nationkey in (3, 14) union select case when h.back then e.src else e.dst end, h.level + 1, h.back from hop h join edges e on case "
    f"when h.back then e.dst else e.src end = h.node where h.level < 2) select distinct c_nationkey as unit from customer join hop on node "
    f"= c_nationkey"
)
def g19_near_works(spark, sf_dir):
    from ..operators.graph import near_works

    works = table(spark, sf_dir, "nation").where("n_nationkey in (3, 14)").select(F.col("n_nationkey").alias("unit"))
    return near_works(table(spark, sf_dir, "customer"), works, edges(spark, sf_dir), "c_nationkey", 3)


@query("select row_number() over (order by p_retailprice desc, p_partkey)::bigint as n, p_partkey from part")
def w5_global_number(spark, sf_dir):
    """All parts, numbered from the dearest."""
    parts = table(spark, sf_dir, "part").select("p_retailprice", "p_partkey")
    return numbering.numbered(parts, [F.desc("p_retailprice"), F.col("p_partkey")]).select("n", "p_partkey")


@query(
    "select o_orderkey, sum((o_totalprice * 100)::bigint) over (order by o_orderdate, o_orderkey)::bigint as cents, "
    "sum(1) over (order by o_orderdate, o_orderkey)::bigint as orders from (select o_orderkey, o_orderdate, o_totalprice::decimal(15, 2) as o_totalprice from orders)"
)
def w4_running_total(spark, sf_dir):
    """What all orders up to each one come to, and how many they are."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", (F.col("o_totalprice").cast("decimal(15,2)") * 100).cast("bigint").alias("price"), F.lit(1).alias("one"))
    return numbering.running_sums(orders, ["o_orderdate", "o_orderkey"], {"cents": "price", "orders": "one"}).select("o_orderkey", "cents", "orders")


@query(
    with_("trips") + ", ods as (select enid, exid, min(entime) < timestamp '1994-01-01' as early from trips group by 1, 2),"
    " old as (select enid, exid, row_number() over (order by enid, exid) as id from ods where early)"
    " select * from old union all select enid, exid, (select coalesce(max(id), 0) from old) + row_number() over (order by enid, exid) from ods where not early"
)
def k4_stable_ids(spark, sf_dir):
    """Ids of pairs after two runs: those of the first, over the trips before 1994, stay in the second over all trips."""
    t = trips(spark, sf_dir).select("enid", "exid", "entime")
    none = spark.createDataFrame([], "enid int, exid int, id bigint")
    old = stored(numbering.grown_ids(none, t.where("entime < timestamp_ntz '1994-01-01'"), ["enid", "exid"]), "od-ids")
    return old.unionByName(numbering.grown_ids(old, t, ["enid", "exid"]))


@query(
    f"with {SQL['edges']}, ids as (select node, row_number() over (order by node) as id from (select src as node from edges union select "
    f"dst from edges)) select src, dst, a.id as source, b.id as target, miles from edges join ids a on src = a.node join ids b on dst = "
    f"b.node"
)
def j11_edge_ids(spark, sf_dir):
    """Edges with the ids of their ends."""
    e = edges(spark, sf_dir)
    nodes = e.select(F.explode(F.array("src", "dst")).alias("node"))
    ids = stored(numbering.grown_ids(spark.createDataFrame([], "node int, id bigint"), nodes, ["node"]), "node-ids")
    return numbering.with_ids(e, ids, {"src": "source", "dst": "target"}, "node").select("src", "dst", "source", "target", F.col("miles").cast("bigint").alias("miles"))


_EARLY = "where entime < timestamp '1997-01-01'"
_RANKED = "select enid, exid, rank() over (partition by enid order by count(*) desc) as rank from trips {} group by 1, 2"


@query(
    with_("trips") + f", old as ({_RANKED.format(_EARLY)}), new as ({_RANKED.format('')}) select o.enid, o.exid, n.rank::int as rank from old o join new "
    f"n on o.enid = n.enid and o.exid = n.exid where o.rank is distinct from n.rank"
)
def k6_changed_ranks(spark, sf_dir):
    """Pairs whose rank by trips is another once all trips count, with the new rank: what a write-back would touch."""
    t = trips(spark, sf_dir).select("enid", "exid", "entime")
    ranks = lambda df: df.groupBy("enid", "exid").agg(F.count("*").alias("n")).withColumn("rank", F.rank().over(Window.partitionBy("enid").orderBy(F.desc("n")))).drop("n")
    return sinks.changed_rows(ranks(t.where("entime < timestamp_ntz '1997-01-01'")), ranks(t), ["enid", "exid"], ["rank"])


@query(
    "with trips as (select o_orderkey as trip_id, substr(o_orderpriority, 1, 1)::int as vehicle_type, o_orderdate as entime, list(s_nationkey order by l_linenumber, l_partkey, l_suppkey) as path from orders join lineitem on o_orderkey = l_orderkey join supplier on l_suppkey = s_suppkey group by all),"
    " works as (select n_nationkey as works_id, [n_nationkey, (n_nationkey + 9) % 25] as units, date '1995-01-01' + (n_nationkey * 40)::int as a, date '1995-01-01' + (n_nationkey * 40 + 120)::int as b from nation where n_nationkey % 7 = 2),"
    " named as (select *, path[1] as enid, path[-1] as exid, array_to_string(path, '|') as path_key from trips),"
    " paths as (select distinct enid, exid, path_key, path from named),"
    " hit as (select works_id, p.*, list_filter(units, lambda u: list_contains(path, u)) as affected, units from paths p, works),"
    " wanted as (select * from hit where (works_id, enid, exid) in (select (works_id, enid, exid) from hit where len(affected) > 0)),"
    " anchored as (select *, coalesce(affected[1], path[1]) as anchor from wanted),"
    " hours as (select distinct trip_id, enid, exid, path_key, vehicle_type, path[i] as unit, date_trunc('hour', entime + (40 * (i - 1)) * interval 1 minute) as hour from named, unnest(range(1, len(path) + 1)) x(i)),"
    " flows as (select t.works_id, t.enid, t.exid, t.path_key, vehicle_type, count(*) filter (hour::date between a and b) as con_flow, count(*) filter (hour::date between (a - interval 12 months)::date and (b - interval 12 months)::date) as sp_flow"
    " from anchored t join works w on t.works_id = w.works_id join hours h on h.enid = t.enid and h.exid = t.exid and h.path_key = t.path_key and h.unit = t.anchor group by 1, 2, 3, 4, 5 having con_flow > 0 or sp_flow > 0),"
    " types as (select distinct works_id, vehicle_type from flows)"
    " select t.works_id, t.enid, t.exid, t.path_key, array_to_string(affected, '|') as affected, len(affected) > 0 as is_affected, anchor, y.vehicle_type, coalesce(con_flow, 0) as con_flow, coalesce(sp_flow, 0) as sp_flow"
    " from anchored t join types y on t.works_id = y.works_id left join flows f on f.works_id = t.works_id and f.enid = t.enid and f.exid = t.exid and f.path_key = t.path_key and f.vehicle_type = y.vehicle_type"
    " where len(affected) = 0 or con_flow > 0 or sp_flow > 0"
)
def a7_anchor_flow(spark, sf_dir):
    """Flow of all paths of affected pairs at their anchors, over four works' periods and the same ones a year before."""
    from ..operators.impact import anchor_flow

    n, first = F.col("n_nationkey"), F.lit("1995-01-01").cast("date")
    works = table(spark, sf_dir, "nation").where("n_nationkey % 7 = 2").select(n.alias("works_id"), F.array(n, (n + 9) % 25).alias("units"), F.date_add(first, (n * 40).cast("int")).alias("start"), F.date_add(first, (n * 40 + 120).cast("int")).alias("end"))
    found = anchor_flow(timed_trips(spark, sf_dir).select("enid", "exid", "path", "times", "vehicle_type"), works)
    return found.withColumn("affected", F.array_join(F.col("affected").cast("array<string>"), "|"))
