"""Registered queries of vehicle classes, loss reports, tolls over distinct paths and the end of the path repair."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import measures, paths
from ..operators import graph, impact, lookup, mining, path_repair, quality, repair, toll
from ..shared import stored
from .adapters import SQL, edges, table, trips, with_
from .queries import _FEE, _RAW, _ROUNDED, _UNITS, _fees, _rates, _rounded, _summary, _units, query

_GROUP = "case when code between 1 and 4 then '客' || code when code between 11 and 16 then '货' || (code - 10) when code between 21 and 26 then '货' || (code - 20) else code::varchar end"


@query(
    f"select code, g as vehicle, case when g[1] = '客' then '客车' when g[1] = '货' then '货车' else '专项' end as category, case when code between "
    f"1 and 10 then code else 0 end as toll_class from (select code, {_GROUP} as g from (select distinct (p_size - 5)::int as code from "
    f"part))"
)
def p12_vehicle_group(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select((F.col("p_size") - 5).cast("int").alias("code")).distinct()
    group = measures.vehicle_group(F.col("code"))
    return codes.select("code", group.alias("vehicle"), measures.vehicle_category(group).alias("category"), measures.toll_class(F.col("code").cast("string")).alias("toll_class"))


_LOSS = "losses as (select enid as section, vehicle_type, (trip_id % 3)::bigint as lost_flow, (trip_id % 4)::bigint as affected_flow from trips)"


def _losses(spark, sf_dir):
    return trips(spark, sf_dir).select(F.col("enid").alias("section"), "vehicle_type", (F.col("trip_id") % 3).alias("lost_flow"), (F.col("trip_id") % 4).alias("affected_flow"))


def _cells(cell: str) -> str:
    return ", ".join(cell.format(v=v) + f" as v{v}" for v in range(1, 6))


@query(
    with_("trips") + f", {_LOSS}, m as (select section, sum(lost_flow)::double as whole, {_cells('coalesce(sum(lost_flow) filter (vehicle_type = {v}), 0)')} "
    f"from losses group by 1) select section, {_cells('round(v{v} * 100 / nullif(whole, 0), 6)')} from m"
)
def a18_share_matrix(spark, sf_dir):
    matrix = impact.share_matrix(impact.loss_matrix(_losses(spark, sf_dir), "section", "vehicle_type", range(1, 6), "lost_flow"), "section")
    return matrix.select("section", *(F.round(f"v{v}", 6).alias(f"v{v}") for v in range(1, 6)))


@query(
    with_("trips") + f", {_LOSS} select section, {_cells('round(coalesce(sum(lost_flow) filter (vehicle_type = {v}) * 100.0::double / nullif(sum(affected_flow) filter (vehicle_type = {v}), 0), 0), 6)')}, "
    f"round(coalesce(sum(lost_flow) * 100.0::double / nullif(sum(affected_flow), 0), 0), 6) as \"all\" from losses group by 1"
)
def a17_rate_matrix(spark, sf_dir):
    found = impact.rate_matrix(_losses(spark, sf_dir), "section", "vehicle_type", range(1, 6))
    return found.select("section", *(F.round(F.col(c), 6).alias(c) for c in found.columns if c != "section"))


@query(
    with_("trips") + f", {_LOSS}, g as (select section, lost_flow, case when code <= 4 then 'cars' else 'special' end as category from (select *, vehicle_type "
    f"as code from losses)) select section, coalesce(sum(lost_flow) filter (category = 'cars'), 0)::bigint as cars, coalesce(sum(lost_flow) "
    f"filter (category = 'special'), 0)::bigint as special from g group by 1"
)
def a18_category_matrix(spark, sf_dir):
    category = measures.vehicle_category(measures.vehicle_group(F.col("vehicle_type")))
    found = impact.loss_matrix(_losses(spark, sf_dir).withColumn("category", category), "section", "category", ["客车", "货车", "专项"], "lost_flow")
    return found.select("section", F.col("v客车").alias("cars"), F.col("v专项").alias("special"))


@query(with_("trips") + f", {_UNITS}, {_FEE.format(src='trips')} select * from fees")
def a31_distinct_tolls(spark, sf_dir):
    found = toll.fees_of_distinct(trips(spark, sf_dir).select("trip_id", "vehicle_type", "path"), _units(spark, sf_dir), _rates(spark))
    return _fees(found.drop("path"))


@query("select s_suppkey, s_nationkey % 2 = 0 as is_control from supplier")
def f3_control_roads(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.format_string("G%010d", "n_nationkey").alias("roadid"), F.when(F.col("n_nationkey") % 2 == 0, toll.PAID_OFF).otherwise("经营性").alias("nature"))
    units = table(spark, sf_dir, "supplier").select("s_suppkey", F.format_string("G%010d-%d", "s_nationkey", "s_suppkey").alias("roadid"))
    return toll.with_control_roads(units, n).select("s_suppkey", "is_control")


_RATIO = "(o_orderkey % 11) / 10.0::double"


@query(f"select case when {_RATIO} >= 0.9 then 'high' when {_RATIO} >= 0.7 then 'medium' else 'low' end as consistency, count(*) as n from orders group by 1")
def a29_consistency(spark, sf_dir):
    return quality.consistency(table(spark, sf_dir, "orders").withColumn("ratio", (F.col("o_orderkey") % 11) / F.lit(10.0)), "ratio")


@query(
    "select count(*) as total_records, count(distinct c_nationkey) as unique_sections, count(distinct c_mktsegment) as unique_types, coalesce(sum(c_custkey), "
    "0)::bigint as total_c_custkey, min(c_name) as min_c_name, max(c_name) as max_c_name from customer"
)
def a26_run_summary(spark, sf_dir):
    return quality.run_summary(table(spark, sf_dir, "customer"), {"sections": "c_nationkey", "types": "c_mktsegment"}, "c_custkey", "c_name")


@query("select o_orderkey from orders order by md5('7|' || o_orderkey), o_orderkey limit 100")
def l7_random_rows(spark, sf_dir):
    return lookup.random_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 100, 7)


@query(
    f"with recursive {SQL['edges']}, hop(source, node, steps) as (select n_nationkey, n_nationkey, 0 from nation union select source, dst, "
    f"steps + 1 from hop join edges on node = src where steps < 24) select source, node as target, min(steps)::int as steps from hop where "
    f"source <> node group by all"
)
def g18_fewest_steps(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    pairs = n.select(F.col("n_nationkey").alias("source")).crossJoin(F.broadcast(n.select(F.col("n_nationkey").alias("target")))).where("source <> target")
    return graph.fewest_steps(pairs, edges(spark, sf_dir)).select("source", "target", (F.size("path") - 1).alias("steps"))


@query(
    with_("trips") + " select trip_id, len(path)::int as points, sum_lon, array_to_string(list_filter(path, lambda u: u % 6 = 5), '|') as missing from trips, "
    "lateral (select sum(100 + u)::bigint as sum_lon from (select unnest(path) as u) where u % 6 <> 5)"
)
def r17_coordinates(spark, sf_dir):
    n = F.col("n_nationkey")
    nodes = table(spark, sf_dir, "nation").where(n % 6 != 5).select(n.alias("unit"), (n + 100).cast("bigint").alias("lon"), (n + 30).alias("lat"))
    found = path_repair.with_coordinates(trips(spark, sf_dir).select("trip_id", "path"), nodes, "trip_id")
    known = F.filter("points", lambda p: p["lon"].isNotNull())
    total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("bigint"), lambda a, p: a + p["lon"]))
    return found.select("trip_id", F.size("points").alias("points"), total.alias("sum_lon"), paths.join_path(F.col("missing")).alias("missing"))


@query(
    with_("trips") + " select trip_id, array_to_string(list_filter(list_transform(path, lambda u: repeat('x', 5 + u % 5) || u), lambda x: len(x) <> 7 and "
    "x <> repeat('x', 5 + enid % 5) || enid and x <> repeat('x', 5 + exid % 5) || exid), '|') as path from trips"
)
def r19_result_path(spark, sf_dir):
    text = lambda u: F.concat(F.repeat(F.lit("x"), (u % 5 + 5).cast("int")), u.cast("string"))
    found = path_repair.result_path(F.transform("path", text), text(F.col("enid")), text(F.col("exid")))
    return trips(spark, sf_dir).select("trip_id", F.array_join(found, "|").alias("path"))


@query()
def r18_best_detours(spark, sf_dir):
    """Ways around works on units 3 and 7 for all pairs of nations; the tests hold the operator against an enumeration."""
    n = table(spark, sf_dir, "nation")
    pairs = n.select(F.col("n_nationkey").alias("source")).crossJoin(F.broadcast(n.select(F.col("n_nationkey").alias("target")))).where("source <> target")
    found = path_repair.best_detours(pairs, edges(spark, sf_dir), [3, 7], _units(spark, sf_dir), _rates(spark), 2)
    return found.withColumns({c: paths.join_path(F.col(c)) for c in ("detour_path", "cheapest_path")} | {c: F.round(c, 6) for c in ("detour_fee", "cheapest_fee")})


@query(
    with_("trips")
    + """, flows as (select enid, exid, array_to_string(path, '|') as fixed, count(*) as flow from trips group by all), run as (select *, coalesce(sum(flow) over (partition by enid, exid order by flow, fixed rows between unbounded preceding and 1 preceding), 0) as before from flows),
    given as (select enid, exid, greatest(0, least(flow, 5 + enid - before))::bigint as allocated, unnest(string_split(fixed, '|'))::int as section from run)
    select section, sum(allocated)::bigint as flow from given where allocated > 0 and section <> enid and section <> exid group by 1"""
)
def a15_section_spread(spark, sf_dir):
    """The flow that greedy_prefix gives to paths, on each of their sections but the ends."""
    t = trips(spark, sf_dir)
    flows = t.withColumn("fixed", paths.join_path(F.col("path"))).groupBy("enid", "exid", "fixed").agg(F.count("*").alias("flow"))
    wanted = t.select("enid", "exid", (F.col("enid") + 5).alias("flow_x")).distinct()
    given = mining.greedy_prefix(flows, wanted, ["enid", "exid"], "flow", "fixed").withColumn("sections", paths.split_path(F.col("fixed")).cast("array<int>"))
    return mining.section_flow(given, "sections", "allocated", ["enid", "exid"]).select(F.col("section").cast("int").alias("section"), F.col("flow").cast("bigint").alias("flow"))


@query("select o_custkey, o_orderdate, count(*) as n from orders where o_orderstatus <> 'P' group by all having count(*) > 1")
def n8_double_assignments(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("route_type", F.when(F.col("o_orderstatus") == "P", "unassigned").otherwise("pass"))
    return quality.double_assignments(o, ["o_custkey", "o_orderdate"])


@query("select o_orderpriority, count(*) as n from orders where o_orderpriority not in ('1-URGENT', '2-HIGH') group by 1")
def dq8_outside(spark, sf_dir):
    return quality.outside(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


_RECORD = (
    "case when k % 7 = 0 then '' when k % 11 <> 0 then 'A' end as origin",
    "case when k % 5 <> 0 then 'B' else '' end as destination",
    "case when k % 13 = 0 then '2024/01/05' else '2024-02-05' end as first",
    "case when k % 3 = 0 then '2024-01-31' when k % 17 = 0 then '2024-02-30' else '2024-02-28' end as last",
    "case k % 4 when 0 then '1|2' when 1 then '1|x|3' when 2 then '' else ' 4||-5 ' end as sections",
)


@query(
    f"""select k, array_to_string(list_filter([case when coalesce(origin, '') = '' then 'origin missing' end, case when destination = '' then 'destination missing' end, case when try_strptime(first, '%Y-%m-%d') is null then 'first day unreadable' end,
    case when try_strptime(last, '%Y-%m-%d') is null then 'last day unreadable' end, case when try_strptime(first, '%Y-%m-%d') > try_strptime(last, '%Y-%m-%d') then 'first day after last' end, case when sections = '' then 'sections missing' end, case when sections like '%x%' then 'section not a number' end], lambda e: e is not null), ',') as errors
    from (select k, {', '.join(_RECORD)} from (select c_custkey as k from customer))"""
)
def dq11_record_errors(spark, sf_dir):
    records = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).selectExpr("k", *_RECORD)
    return records.select("k", F.array_join(quality.record_errors(*(F.col(c) for c in ("origin", "destination", "first", "last", "sections"))), ",").alias("errors"))


@query()
def r1_repair_report(spark, sf_dir):
    """Each different trip path with all that its repair says: scores, coordinates, units without, works met, ways around them."""
    records = trips(spark, sf_dir).where("enid <> exid").groupBy("enid", "exid", "path").agg(F.min("trip_id").alias("record_id"))
    n = F.col("n_nationkey")
    nodes = table(spark, sf_dir, "nation").where(n % 8 != 6).select(n.alias("unit"), (n % 13 + 100).cast("double").alias("lon"), (n % 11 + 30).cast("double").alias("lat"))
    found = path_repair.repair_report(records, edges(spark, sf_dir), "record_id", nodes, [3, 7], _units(spark, sf_dir), _rates(spark), 2)
    shown = {c: paths.join_path(F.col(c)) for c in ("path", "result", "missing", "detour_path", "cheapest_path")}
    return found.withColumns(shown | {"points": F.size("points")})


@query(
    with_("trips") + _RAW + ", named as (select enid, case when vehicle_type <= 3 then '客' || vehicle_type else '货' || (vehicle_type - 3) end as kind, case when vehicle_type <= 3 then '客车' else '货车' end as category, ref_total_flow, affected_flow::double as affected, lost_flow::double as lost, lost_control_fee as fee from summary),"
    " by_type as (select enid, kind, category, sum(affected) as affected, sum(lost) as lost, sum(fee) as fee from named group by all),"
    " ranked as (select *, row_number() over (partition by enid order by lost desc, kind) as n1, row_number() over (partition by enid order by case when affected > 0 then lost / affected end desc nulls last, kind) as n2 from by_type),"
    " found as (select enid, sum(affected) as affected, sum(lost) as lost, sum(fee) as fee, max(kind) filter (n1 = 1) as main, max(lost) filter (n1 = 1) as main_lost, max(kind) filter (n2 = 1 and affected > 0) as high, max(lost * 100 / affected) filter (n2 = 1 and affected > 0) as high_rate,"
    " coalesce(sum(lost) filter (category = '客车'), 0) as cars, coalesce(sum(lost) filter (category = '货车'), 0) as lorries from ranked group by 1),"
    " top as (select *, row_number() over (order by lost desc, enid) as n from found order by lost desc, enid limit 15), totals as (select enid, sum(ref_total_flow)::bigint as ref_total_flow from named group by 1)"
    " select 'TOP' || lpad(n::varchar, 2, '0') as label, enid, ref_total_flow, affected as affected_flow, lost as lost_flow, case when affected > 0 then round_even(lost * 100 / affected, 1) else 0 end as loss_rate, round_even(fee, 2) as lost_control_fee,"
    " case when lost > 0 then round_even(fee / lost * 10000, 0) else 0 end as fee_per_vehicle, case when lost > 0 then main || '(' || round_even(main_lost * 100 / lost, 0)::bigint || '%)' else '-(0%)' end as main_type,"
    " coalesce(high || '(' || round_even(high_rate, 0)::bigint || '%)', '-(0%)') as highest_rate_type, case when lost > 0 then round_even(cars * 100 / lost, 1) else 0 end as cars_share, case when lost > 0 then round_even(lorries * 100 / lost, 1) else 0 end as lorries_share from top join totals using (enid)"
)
def a20_evaluation_table(spark, sf_dir):
    rows = _summary(spark, sf_dir)
    kind = F.when(F.col("vehicle_type") <= 3, F.concat(F.lit("客"), F.col("vehicle_type").cast("string"))).otherwise(F.concat(F.lit("货"), (F.col("vehicle_type") - 3).cast("string")))
    named = rows.withColumns({"kind": kind, "category": F.when(F.col("vehicle_type") <= 3, impact.CARS).otherwise(impact.LORRIES)})
    totals = rows.groupBy("enid").agg(F.sum("ref_total_flow").cast("bigint").alias("ref_total_flow"))
    return impact.evaluation_table(named, totals, "enid", "kind", "category")


_LINE = "(select list({'lon': (100 + n * 0.01)::double, 'lat': (30 + (n * 7 % 5) * 0.01)::double} order by n) as line from range(8) t(n))"


@query(
    f"with line as {_LINE}, seg as (select c_custkey, (100 + (c_custkey % 97) * 0.001)::double as lon, (30 + (c_custkey % 61) * 0.001)::double as lat, line[greatest(i - 1, 1)] as a, line[i] as b, len(line) as n from customer, line, unnest(range(1, len(line) + 1)) x(i)),"
    " flat as (select c_custkey, lon, lat, (a.lon - lon) * cos(radians(lat)) * k as ax, (a.lat - lat) * k as ay, (b.lon - lon) * cos(radians(lat)) * k as bx, (b.lat - lat) * k as \"by\" from seg, (select 6371000.0::double * radians(1.0) as k)),"
    " near as (select *, coalesce(greatest(0, least(1, -(ax * (bx - ax) + ay * (\"by\" - ay)) / nullif((bx - ax) ** 2 + (\"by\" - ay) ** 2, 0))), 0) as t from flat)"
    " select c_custkey, round(min(sqrt((ax + t * (bx - ax)) ** 2 + (ay + t * (\"by\" - ay)) ** 2)), 3) as metres, 'LINESTRING' as kind from near group by 1"
)
def f13_distance_to_line(spark, sf_dir):
    """Each customer's distance from a line of eight points."""
    points = F.array(*(F.struct((F.lit(100) + F.lit(n * 0.01)).cast("double").alias("lon"), (F.lit(30) + F.lit((n * 7 % 5) * 0.01)).cast("double").alias("lat")) for n in range(8)))
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.lit(100) + (F.col("c_custkey") % 97) * 0.001).cast("double").alias("lon"), (F.lit(30) + (F.col("c_custkey") % 61) * 0.001).cast("double").alias("lat"), points.alias("line"))
    return c.select("c_custkey", F.round(measures.distance_to_line_m(F.col("lon"), F.col("lat"), F.col("line")), 3).alias("metres"), measures.geometry_type(measures.with_srid(measures.wkt_line(F.col("line")))).alias("kind"))


@query(
    "select src, dst, min(coalesce(nullif(miles, 0), 1))::bigint as miles, 1e9::double as reverse_miles from (select case when l_linenumber "
    "<> 6 then l_suppkey end as src, l_partkey % 50 as dst, case when l_linenumber = 5 then null else l_orderkey % 4 end as miles, l_linenumber "
    "% 2 as version from lineitem) where version = 1 and src is not null and dst is not null group by 1, 2"
)
def g1_built_edges(spark, sf_dir):
    """Suppliers and groups of parts as a graph, with missing and zero miles."""
    line = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(F.when(line != 6, F.col("l_suppkey")).alias("src"), (F.col("l_partkey") % 50).alias("dst"), F.when(line != 5, F.col("l_orderkey") % 4).alias("miles"), (line % 2).cast("string").alias("version"))
    return graph.built_edges(rows, "1").withColumn("miles", F.col("miles").cast("bigint"))


@query(
    with_("trips") + _RAW + ", named as (select *, case enid % 5 when 0 then null when 1 then '' else (enid % 5) || '-' || (exid // 5) end as section_od from summary)"
    ", total as (select section_od, " + ", ".join(f"sum({m}) as {m}" for m in measures.MEASURES) + " from named where section_od <> '' group by 1)"
    f" select section_od, {_ROUNDED} from total"
)
def a10_section_rollup(spark, sf_dir):
    """The measures of each section pair; rows that have none go."""
    section = F.when(F.col("enid") % 5 == 0, None).when(F.col("enid") % 5 == 1, "").otherwise(F.concat_ws("-", (F.col("enid") % 5).cast("string"), F.floor(F.col("exid") / 5).cast("string")))
    return _rounded(impact.measure_roll_up(_summary(spark, sf_dir).withColumn("section_od", section), ["section_od"]), "section_od")


@query(
    with_("trips") + ", freq as (select year(entime)::int as version, enid, exid, array_to_string(path, '|') as numpath, count(*) as n from trips group by all),"
    " best as (select *, n / sum(n) over (partition by version, enid, exid) as ratio, row_number() over (partition by version, enid, exid order by n desc, numpath) as k from freq),"
    " f as (select version, count(*) as freq_count from freq group by 1)"
    " select version, count(*) as map_count, count(distinct (enid, exid)) as od_pair_count, count(distinct numpath) as numpath_count, round(avg(ratio), 4) as avg_freq_ratio,"
    " round(min(ratio), 3) as min_freq_ratio, round(max(ratio), 3) as max_freq_ratio, any_value(freq_count) as freq_count from best join f using (version) where k = 1 group by 1"
)
def a29_map_summary(spark, sf_dir):
    """Figures of the map of best paths of each year."""
    from ..operators import flow

    freq = stored(flow.path_frequency(trips(spark, sf_dir).select(F.year("entime").alias("version"), "enid", "exid", paths.join_path(F.col("path")).alias("numpath")), ["version", "enid", "exid", "numpath"]), "path-frequency")
    total = F.sum("ig_count").over(Window.partitionBy("version", "enid", "exid"))
    best = flow.ranked_frequency(freq.withColumn("ratio", F.col("ig_count") / total), ["version", "enid", "exid"], "numpath").where("row_no = 1")
    found = quality.map_summary(best, freq, "version", ("enid", "exid"), "numpath", "ratio")
    return found.withColumns({"avg_freq_ratio": F.round("avg_freq_ratio", 4), "min_freq_ratio": F.round("min_freq_ratio", 3), "max_freq_ratio": F.round("max_freq_ratio", 3)})


@query(
    "select c_custkey, array_to_string(list_filter([case when not (c between 0 and 100) then 'confidence out of range' end, case when b is null or not (b between 0 and 100) then 'backtrack index out of range' end,"
    " case when n = 0 and k % 4 <> 0 then 'path empty' end, case when n > 0 and noted > 0 and noted <> n then 'unit count differs' end], lambda x: x is not null), '|') as errors"
    " from (select c_custkey, c_custkey as k, c_custkey % 121 - 10 as c, case when c_custkey % 9 = 0 then null else c_custkey % 107 - 3 end as b, c_custkey % 3 as n, c_custkey % 5 as noted from customer)"
)
def r20_repair_errors(spark, sf_dir):
    k = F.col("c_custkey")
    status = F.when(k % 4 == 0, "FAILED_NO_PATH").otherwise("LOW_CONFIDENCE")
    path = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (k % 3).cast("int"))
    errors = path_repair.repair_errors(k % 121 - 10, F.when(k % 9 != 0, k % 107 - 3), status, path, k % 5)
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(errors, "|").alias("errors"))


@query()
def r20_batch_figures(spark, sf_dir):
    """Figures of a batch of repairs of all trips."""
    return path_repair.repair_batch(trips(spark, sf_dir).select("trip_id", "enid", "exid", "path"), edges(spark, sf_dir), "trip_id")[1]


@query()
def k12_rejected(spark, sf_dir):
    """Trips with a gap that no way closes, on a graph without the edges into three units."""
    unit = lambda c: F.concat(F.lit("G00"), F.lpad(F.col(c).cast("string"), 9, "0"), F.lit("0010"))
    e = edges(spark, sf_dir).where("dst not in (3, 9, 17)").select(unit("src").alias("src"), unit("dst").alias("dst"), "miles")
    path = F.transform("path", lambda u: F.concat(F.lit("G00"), F.lpad(u.cast("string"), 9, "0"), F.lit("0010")))
    none = F.lit(None).cast("timestamp_ntz")
    records = trips(spark, sf_dir).select("trip_id", path.alias("path"), F.lit(None).cast("array<timestamp_ntz>").alias("times"), F.lit("").alias("enid"), F.lit("").alias("exid"), none.alias("entime"), none.alias("extime"))
    return repair.rejected(repair.repair_intervals(records, e, "trip_id")).select("trip_id", paths.join_path(F.col("path")).alias("path"), "error")
