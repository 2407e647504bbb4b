"""Registered queries of the graph, anchor and repair operators with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths
from ..operators import anchors, graph, repair, toll
from ..shared import stored
from .adapters import SQL, edges, table, timed_trips, trips
from .queries import _FEE, _UNITS, _fees, _rates, _units, query

_CTE = "with recursive "
_DEPTH = 14


def _simple(sources: str, depth: int, banned: str = "") -> str:
    skip, start = (f"and e.dst not in ({banned})", f"and n_nationkey not in ({banned})") if banned else ("", "")
    return f"""{SQL['edges']}, simple(source, target, miles, path) as (
        select n_nationkey, n_nationkey, 0::bigint, [n_nationkey] from nation where n_nationkey in ({sources}) {start}
        union all select s.source, e.dst, s.miles + e.miles, list_append(s.path, e.dst) from simple s join edges e on e.src = s.target
        where not list_contains(s.path, e.dst) and len(s.path) <= {depth} {skip}),
    ranked as (select *, row_number() over (partition by source, target order by miles, len(path), path) as path_no from simple where source <> target)"""


def _pairs(spark, sf_dir):
    """Each unit with each other one: the stated pairs of the graph queries, as many as the square of the 25 units."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    return n.select(F.col("n").alias("source")).crossJoin(F.broadcast(n.select(F.col("n").alias("target")))).where("source <> target")


def _named(df):
    return df.select("source", "target", "path_no", "miles", paths.join_path(F.col("path")).alias("path"))


_ROWS = "source, target, path_no::int as path_no, miles::double as miles, array_to_string(path, '|') as path"


@query(_CTE + _simple("select n_nationkey from nation", _DEPTH) + f" select {_ROWS} from ranked where path_no = 1")
def g2_shortest_path(spark, sf_dir):
    return _named(graph.shortest_paths(_pairs(spark, sf_dir), edges(spark, sf_dir)))


@query(_CTE + _simple("select n_nationkey from nation", _DEPTH) + f" select {_ROWS} from ranked where path_no <= 3")
def g3_ksp(spark, sf_dir):
    return _named(graph.k_shortest_paths(_pairs(spark, sf_dir), edges(spark, sf_dir), 3))


@query(_CTE + _simple("select n_nationkey from nation", _DEPTH, "3, 7") + f" select {_ROWS} from ranked where path_no = 1")
def g4_excluding(spark, sf_dir):
    return _named(graph.shortest_paths(_pairs(spark, sf_dir), edges(spark, sf_dir), excluded=[3, 7]))


@query()
def g5_disjoint(spark, sf_dir):
    return _named(graph.disjoint_paths(_pairs(spark, sf_dir), edges(spark, sf_dir), 3))


@query(_CTE + _simple("select n_nationkey from nation", 6) + " select source, target, miles, array_to_string(path, '|') as path from ranked")
def g6_all_paths(spark, sf_dir):
    sources = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"))
    return graph.simple_paths(edges(spark, sf_dir), sources, 6).select("source", "target", "miles", paths.join_path(F.col("path")).alias("path"))


@query(
    _CTE + _simple("select n_nationkey from nation", 6) + ", least_of as (select *, min(miles) over (partition by source, target) as m from ranked) select source, target, path_no::int as path_no, "
    "miles, array_to_string(path, '|') as path from least_of where miles <= 2 * m and path_no <= 4"
)
def g10_bounded(spark, sf_dir):
    return _named(graph.bounded_search(_pairs(spark, sf_dir), edges(spark, sf_dir), 2.0, 6, 4))


def _levels(start: str, depth: int, more: str = "", a: str = "src", b: str = "dst") -> str:
    return f"lv(source, node, level) as ({start} union select l.source, e.{b}, l.level + 1 from lv l join edges e on e.{a} = l.node where l.level < {depth} {more})"


@query(
    f"{_CTE}{SQL['edges']}, {_levels('select n_nationkey, n_nationkey, 0 from nation', 6)}, m as (select source, node, min(level) as level "
    f"from lv group by 1, 2), c as (select source, level, count(*) as n from m group by 1, 2) select source, level, n, sum(n) over (partition "
    f"by source order by level)::bigint as reached from c"
)
def g11_reach_by_depth(spark, sf_dir):
    from pyspark.sql.window import Window

    sources = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("source"))
    n = graph.reach_levels(edges(spark, sf_dir), sources, 6).groupBy("source", "level").agg(F.count("*").alias("n"))
    return n.withColumn("reached", F.sum("n").over(Window.partitionBy("source").orderBy("level")))


_WORKS = "works as (select case when n_nationkey < 13 then 1 else 2 end as works_id, n_nationkey as unit from nation where n_nationkey in (3, 4, 5, 8, 10, 14, 15, 16, 19, 22, 23))"
_PARTS = f"""{SQL['edges']}, {_WORKS}, und as (select a.works_id, a.unit as u, b.unit as v from works a join edges e on e.src = a.unit join works b on b.works_id = a.works_id and b.unit = e.dst),
    both_ways as (select works_id, u, v from und union select works_id, v, u from und),
    cc(works_id, unit, seen) as (select works_id, unit, unit from works union select c.works_id, c.unit, b.v from cc c join both_ways b on b.works_id = c.works_id and b.u = c.seen),
    parts as (select works_id, unit, min(seen) as component from cc group by 1, 2),
    doors as (select distinct p.works_id, p.component, p.unit, 'entry' as kind from parts p join edges e on e.dst = p.unit where not exists (select 1 from parts q where q.works_id = p.works_id and q.component = p.component and q.unit = e.src)
        union all select distinct p.works_id, p.component, p.unit, 'exit' from parts p join edges e on e.src = p.unit where not exists (select 1 from parts q where q.works_id = p.works_id and q.component = p.component and q.unit = e.dst))"""


def _works(spark, sf_dir):
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey").isin(3, 4, 5, 8, 10, 14, 15, 16, 19, 22, 23))
    return n.select(F.when(F.col("n_nationkey") < 13, 1).otherwise(2).alias("works_id"), F.col("n_nationkey").alias("unit"))


def _parts(spark, sf_dir):
    return graph.works_components(_works(spark, sf_dir), edges(spark, sf_dir))


@query(_CTE + _PARTS + " select * from parts")
def g14_components(spark, sf_dir):
    return _parts(spark, sf_dir)


@query(_CTE + _PARTS + " select * from doors")
def g15_portals(spark, sf_dir):
    return graph.portals(stored(_parts(spark, sf_dir), "anchor-parts"), edges(spark, sf_dir))


@query(f"{_CTE}{SQL['edges']}, {_levels('select n_nationkey, n_nationkey, 0 from nation', 12, 'and e.dst % 3 <> 0')} select source, node, min(level)::int as level from lv group by 1, 2")
def g16_reachable(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return graph.reach_levels(edges(spark, sf_dir), n.select(F.col("n_nationkey").alias("source")), 12, allowed=n.where("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("node")))


@query(f"{_CTE}{SQL['edges']}, {_levels('select n_nationkey, n_nationkey, 0 from nation', 5, 'and e.src not in (10, 11)', 'dst', 'src')} select source, node, min(level)::int as level from lv group by 1, 2")
def g17_bfs_levels(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return graph.reach_levels(edges(spark, sf_dir), n.select(F.col("n_nationkey").alias("source")), 5, blocked=n.where("n_nationkey in (10, 11)").select(F.col("n_nationkey").alias("node")), backwards=True)


@query(
    f"with {SQL['edges']} select origin, unit, min(level)::int as level from (select src as origin, dst as unit, 1 as level from edges union "
    f"all select d.src, e.dst, 2 from edges d join edges e on e.src = d.dst) group by 1, 2"
)
def j21_neighbour_drill(spark, sf_dir):
    """Each unit's neighbours and theirs."""
    return graph.drilled(edges(spark, sf_dir))


_RECORDS = ", records as (select trip_id as record_id, enid, exid, path, 1 as flow from trips)"


def _records(spark, sf_dir):
    return trips(spark, sf_dir).select(F.col("trip_id").alias("record_id"), "enid", "exid", "path", F.lit(1).alias("flow"))


_WINDOWS = f"""{_PARTS}, {SQL['trips']}{_RECORDS},
    inner_edges as (select p.works_id, p.component, e.src, e.dst from edges e join parts p on p.unit = e.src join parts q on q.unit = e.dst and q.works_id = p.works_id and q.component = p.component),
    rch(works_id, component, start_unit, unit) as (select works_id, component, unit, unit from doors where kind = 'entry' union select r.works_id, r.component, r.start_unit, i.dst from rch r join inner_edges i on i.works_id = r.works_id and i.component = r.component and i.src = r.unit),
    covers as (select works_id, component, start_unit, list(distinct unit order by unit) as covered from rch group by 1, 2, 3),
    portal_w as (select c.works_id, c.component, start_unit, d.unit as end_unit, covered from covers c join doors d on d.works_id = c.works_id and d.component = c.component and d.kind = 'exit' where list_contains(covered, d.unit)),
    sites as (select works_id, list(unit order by unit) as units from parts group by 1),
    hit as (select works_id, units, list_filter(path, lambda x: list_contains(units, x)) as h, flow from records join sites on list_has_any(path, units)),
    hit_w as (select works_id, h[1] as start_unit, h[-1] as end_unit, any_value(units) as units, sum(flow)::bigint as flow, count(*) as n from hit where h[1] <> h[-1] group by 1, 2, 3),
    win0 as (select works_id, start_unit, end_unit, covered, 0::double as flow, 'portal' as source from portal_w union all select works_id, start_unit, end_unit, list_filter(units, lambda u: u >= least(start_unit, end_unit) and u <= greatest(start_unit, end_unit)), flow::double, 'path_hit' from hit_w),
    win as (select * exclude (n) from (select *, row_number() over (partition by works_id, start_unit, end_unit order by flow desc, source desc) as n from win0) where n = 1),
    up(works_id, start_unit, end_unit, covered, node, level) as (select works_id, start_unit, end_unit, covered, start_unit, 0 from win union select u.works_id, u.start_unit, u.end_unit, u.covered, e.src, u.level + 1 from up u join edges e on e.dst = u.node where u.level < 5 and not list_contains(u.covered, e.src)),
    down(works_id, start_unit, end_unit, covered, node, level) as (select works_id, start_unit, end_unit, covered, end_unit, 0 from win union select u.works_id, u.start_unit, u.end_unit, u.covered, e.dst, u.level + 1 from down u join edges e on e.src = u.node where u.level < 5 and not list_contains(u.covered, e.dst)),
    up1 as (select works_id, start_unit, end_unit, any_value(covered) as covered, node as anchor_start, min(level) as level from up group by works_id, start_unit, end_unit, node), down1 as (select works_id, start_unit, end_unit, node as anchor_end, min(level) as level from down group by works_id, start_unit, end_unit, node),
    cand as (select * from up1 join down1 using (works_id, start_unit, end_unit, level)),
    met as (select c.*, r.enid, r.exid, r.flow, list_has_any(path, covered) as passes from cand c join records r on list_position(path, anchor_start) > 0 and list_position(list_reverse(path), anchor_end) > 0 and list_position(path, anchor_start) < len(path) + 1 - list_position(list_reverse(path), anchor_end)),
    stats as (select works_id, start_unit, end_unit, level, anchor_start, anchor_end, coalesce(sum(flow) filter (passes), 0)::bigint as pass_flow, coalesce(sum(flow) filter (not passes), 0)::bigint as bypass_flow, count(*) filter (passes) as pass_count, count(*) filter (not passes) as bypass_count, count(distinct (enid, exid)) as od_count from met group by 1, 2, 3, 4, 5, 6),
    judged as (select cand.*, coalesce(pass_flow, 0) >= 1 and coalesce(bypass_flow, 0) >= 1 as is_valid from cand left join stats using (works_id, start_unit, end_unit, level, anchor_start, anchor_end)),
    nearest as (select * from (select *, coalesce(max(is_valid::int) over (partition by works_id, start_unit, end_unit order by level, anchor_start, anchor_end rows between unbounded preceding and 1 preceding), 0) as before from judged) where before = 0),
    flat as (select works_id, anchor_start, anchor_end, min(level) as min_level, list_sort(list_distinct(flatten(list(covered)))) as covered, count(*) as window_count from nearest group by 1, 2, 3)"""
_CONFIG = anchors.AnchorConfig()


def _anchor_inputs(spark, sf_dir):
    """Parts of the works, edges and the records' different paths, each stored once."""
    return stored(_parts(spark, sf_dir), "anchor-parts"), stored(edges(spark, sf_dir), "anchor-edges"), anchors.distinct_paths(_records(spark, sf_dir))


def _anchor_windows(spark, sf_dir, inputs=None):
    parts, e, different = inputs or _anchor_inputs(spark, sf_dir)
    return anchors.combined_windows(anchors.portal_windows(parts, e), anchors.hit_windows(None, parts, _CONFIG, different), parts)


def _anchor_candidates(spark, sf_dir, inputs):
    return stored(anchors.anchor_candidates(_anchor_windows(spark, sf_dir, inputs), inputs[1], _CONFIG), "anchor-candidates")


def _text(df):
    return df.withColumn("covered", paths.join_path(F.col("covered")))


@query(_CTE + _WINDOWS + " select works_id, component, start_unit, end_unit, array_to_string(covered, '|') as covered from portal_w")
def n1_portal_windows(spark, sf_dir):
    return _text(anchors.portal_windows(stored(_parts(spark, sf_dir), "anchor-parts"), stored(edges(spark, sf_dir), "anchor-edges")))


@query(_CTE + _WINDOWS + " select works_id, start_unit, end_unit, flow, n from hit_w")
def n2_hit_windows(spark, sf_dir):
    return anchors.hit_windows(_records(spark, sf_dir), _parts(spark, sf_dir), _CONFIG)


@query(_CTE + _WINDOWS + " select works_id, start_unit, end_unit, array_to_string(covered, '|') as covered, flow, source from win")
def n4_windows(spark, sf_dir):
    return _text(_anchor_windows(spark, sf_dir))


@query(_CTE + _WINDOWS + " select * from stats")
def a21_anchor_stats(spark, sf_dir):
    inputs = _anchor_inputs(spark, sf_dir)
    return anchors.anchor_stats(_anchor_candidates(spark, sf_dir, inputs), None, inputs[2])


def _nearest(spark, sf_dir):
    inputs = _anchor_inputs(spark, sf_dir)
    candidates = _anchor_candidates(spark, sf_dir, inputs)
    return anchors.nearest_anchors(candidates, anchors.anchor_stats(candidates, None, inputs[2]), _CONFIG)


@query(_CTE + _WINDOWS + " select works_id, start_unit, end_unit, level, anchor_start, anchor_end, is_valid from nearest")
def n5_nearest_anchors(spark, sf_dir):
    return _nearest(spark, sf_dir).select("works_id", "start_unit", "end_unit", "level", "anchor_start", "anchor_end", "is_valid")


@query(_CTE + _WINDOWS + " select * replace (array_to_string(covered, '|') as covered) from flat")
def n6_merged_anchors(spark, sf_dir):
    return _text(anchors.merged_anchors(_nearest(spark, sf_dir)))


@query(_CTE + _WINDOWS + """, choice as (select r.record_id, f.works_id, anchor_start, anchor_end, case when list_has_any(path, units) then 'pass' else 'bypass' end as route_type, row_number() over (partition by record_id order by min_level, len(covered), anchor_start, anchor_end, f.works_id) as n
      from records r join flat f on list_position(path, anchor_start) > 0 and list_position(list_reverse(path), anchor_end) > 0 and list_position(path, anchor_start) < len(path) + 1 - list_position(list_reverse(path), anchor_end) join sites s on s.works_id = f.works_id)
    select r.record_id, r.enid, r.exid, r.flow, c.works_id, c.anchor_start, c.anchor_end, coalesce(c.route_type, 'unassigned') as route_type from records r left join choice c on c.record_id = r.record_id and c.n = 1""")
def n7_assignment(spark, sf_dir):
    return anchors.aggregate(_records(spark, sf_dir), _works(spark, sf_dir), edges(spark, sf_dir), _CONFIG)[1]


@query(
    _CTE + _simple("select n_nationkey from nation", _DEPTH) + f", {SQL['trips']}, {_UNITS}, "
    "own as (select trip_id, vehicle_type, path from trips where enid <> exid), "
    "best as (select t.trip_id, t.vehicle_type, r.path from trips t join ranked r on r.source = t.enid and r.target = t.exid and r.path_no = 1), "
    + _FEE.format(src="own") + ", " + _FEE.format(src="best").replace("fees as", "best_fees as", 1)
    + " select f.trip_id, f.vehicle_type, f.fee as path_fee, b.fee as shortest_fee, greatest(f.fee, b.fee) as fee from fees f left join best_fees b using (trip_id, vehicle_type)"
)
def f4_od_toll(spark, sf_dir):
    own = trips(spark, sf_dir).where("enid <> exid").select("trip_id", "vehicle_type", "enid", "exid", "path")
    best = graph.shortest_paths(own.select(F.col("enid").alias("source"), F.col("exid").alias("target")), edges(spark, sf_dir))
    driven = own.drop("path").join(best.select(F.col("source").alias("enid"), F.col("target").alias("exid"), "path"), ["enid", "exid"])
    # each different path is priced once a type, whether it was driven or is the shortest one
    both = own.select("trip_id", "vehicle_type", "path", F.lit(True).alias("own")).unionByName(driven.select("trip_id", "vehicle_type", "path", F.lit(False).alias("own")))
    priced = stored(_fees(toll.fees_of_distinct(both, _units(spark, sf_dir), _rates(spark))).drop("path"), "od-toll")
    return toll.od_toll(priced.where("own").drop("own"), priced.where("not own").drop("own"), ["trip_id", "vehicle_type"])


@query()
def q_fix_interval(spark, sf_dir):
    """Trips' paths with their gaps closed on the nation graph."""
    name = lambda c: F.concat(F.lit("G00"), F.lpad(F.col(c).cast("string"), 9, "0"), F.lit("0010"))
    e = edges(spark, sf_dir).select(name("src").alias("src"), name("dst").alias("dst"), "miles")
    units = F.transform("path", lambda u: F.concat(F.lit("G00"), F.lpad(u.cast("string"), 9, "0"), F.lit("0010")))
    records = timed_trips(spark, sf_dir).select("trip_id", units.alias("path"), "times", F.lit("").alias("enid"), F.lit("").alias("exid"), "entime", F.col("entime").alias("extime"))
    found = repair.repair_intervals(records, e, "trip_id")
    return found.select("trip_id", paths.join_path(F.col("path")).alias("path"), F.size("times").alias("n_times"), F.size("changes").alias("n_changes"), "error")


@query()
def r1_path_repair(spark, sf_dir):
    """Trips' distinct paths repaired on the nation graph, miles taken as metres."""
    from ..operators.path_repair import repair_paths

    records = trips(spark, sf_dir).where("enid <> exid").groupBy("enid", "exid", "path").agg(F.min("trip_id").alias("record_id"))
    found = repair_paths(records, edges(spark, sf_dir), "record_id")
    return found.withColumn("path", paths.join_path(F.col("path")))


@query(
    "with recursive " + SQL["trips"] + " select trip_id, case when list_position(path, 3) > 0 and list_position(list_reverse(path), 7) > 0 and list_position(path, 3) < len(path) + 1 - list_position(list_reverse(path), 7)"
    " then case when list_has_any(path, [4, 10, 11]) then 'pass' else 'bypass' end else 'none' end as kind from trips"
)
def q_window_class(spark, sf_dir):
    """How each trip goes by a window from unit 3 to unit 7."""
    units = F.array(*(F.lit(u) for u in (4, 10, 11)))
    return trips(spark, sf_dir).select("trip_id", paths.window_class(F.col("path"), F.lit(3), F.lit(7), units).alias("kind"))
