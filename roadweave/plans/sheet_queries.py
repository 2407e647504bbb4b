"""Registered queries of sheets and path reports with their SQL. Units are seen as gates of two directions and as stations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import path_report, sheets
from .adapters import edges, table, trips, with_
from .graph_queries import _CTE, _DEPTH, _simple
from .queries import query

TYPOS = {"G0OO56": "G00056"}
_GATE, _STATION = "G0005610010", "S0005610010"


def _gate(n, way="10"):
    return F.concat(F.lit(_GATE), F.lpad(n.cast("string"), 3, "0"), F.lit(way) if isinstance(way, str) else way)


def gate_edges(spark, sf_dir):
    """The graph between gates of direction 10, and the other way round between those of 20."""
    e = edges(spark, sf_dir)
    back = e.select(_gate(F.col("dst"), "20").alias("src"), _gate(F.col("src"), "20").alias("dst"), "miles")
    return e.select(_gate(F.col("src")).alias("src"), _gate(F.col("dst")).alias("dst"), "miles").unionByName(back)


def _sheet(spark, sf_dir):
    """A trip's units as people type them: gates of either direction, stations, odd ids and separators, a typing error."""
    t = trips(spark, sf_dir).select("trip_id", "path")
    way = lambda u: F.when((F.col("trip_id") + u) % 4 == 0, "20").otherwise("10")
    one = lambda u, i: F.when((F.col("trip_id") + i) % 11 == 10, F.concat(F.lit(_STATION), F.lpad(u.cast("string"), 3, "0"))).when((F.col("trip_id") + i) % 13 == 12, F.concat(F.lit("X"), u.cast("string"))).otherwise(_gate(u, way(u)))
    parted = lambda by: F.array_join(F.transform("path", one), by)
    text = F.when(F.col("trip_id") % 3 == 0, parted("|")).when(F.col("trip_id") % 3 == 1, parted(",")).otherwise(parted("\n"))
    return t.select("trip_id", F.when(F.col("trip_id") % 5 == 0, F.replace(text, F.lit("G00056"), F.lit("G0OO56"))).otherwise(text).alias("units"))


_NODES = _simple("select n_nationkey from nation", _DEPTH)
_TURN = "case when right({0}, 2) = '10' then left({0}, 14) || '20' else left({0}, 14) || '10' end"
_SHEET = f"""
    gates as (select printf('{_GATE}%03d10', n_nationkey) as g, n_nationkey as n from nation),
    hops as (
        select printf('{_GATE}%03d10', source) as s, printf('{_GATE}%03d10', target) as t, len(path) as n from ranked where path_no = 1
        union all select printf('{_GATE}%03d20', target), printf('{_GATE}%03d20', source), len(path) from ranked where path_no = 1),
    typed as (
        select trip_id, list_transform(range(1, len(path) + 1), lambda i: case
            when (trip_id + i - 1) % 11 = 10 then printf('{_STATION}%03d', path[i])
            when (trip_id + i - 1) % 13 = 12 then 'X' || path[i]
            else printf('{_GATE}%03d', path[i]) || case when (trip_id + path[i]) % 4 = 0 then '20' else '10' end end) as ids from trips),
    fields as (
        select trip_id, ids, replace(array_to_string(ids, '|'), '|', case trip_id % 3 when 0 then '|' when 1 then ',' else chr(10) end) as corrected from typed),
    sheet as (
        select *, case when trip_id % 5 = 0 then replace(corrected, 'G00056', 'G0OO56') else corrected end as before,
            list_filter(ids, lambda u: length(u) = 16) as gates, list_filter(ids, lambda u: length(u) = 14) as stations from fields),
    lists as (select distinct gates, gates[1] as a, gates[-1] as b from sheet where len(gates) > 1),
    ways as (
        select gates, way, case when way >= 2 then {_TURN.format('a')} else a end as s, case when way % 2 = 1 then {_TURN.format('b')} else b end as t
        from lists, (values (0), (1), (2), (3)) w(way)),
    routes as (
        select w.gates, arg_min(s, n * 10 + way) as s, arg_min(t, n * 10 + way) as t from ways w join hops using (s, t) group by 1),
    each as (
        select l.gates, r.s, l.gates[i] as u, i from lists l join routes r on l.gates = r.gates, unnest(range(1, len(l.gates) + 1)) x(i)),
    placed as (
        select e.gates, e.i, e.u, case when e.u = e.s then 1 else o.n end as own, b.n as turned from each e
        left join hops o on o.s = e.s and o.t = e.u left join hops b on b.s = e.s and b.t = {_TURN.format('e.u')}),
    ordered as (
        select gates, list(case when own is null and turned is not null then {_TURN.format('u')} else u end order by coalesce(own, turned, 1073741824), i) as ordered,
            list(u order by i) filter (own is null and turned is null) as lost,
            list(u order by i) filter (own is null and turned is not null) as turned
        from placed group by 1),
    inner_units as (
        select gates, a, b, gates[i] as u, i from lists, unnest(range(2, len(gates))) x(i)),
    ends as (
        select gates, u, i, e, f from inner_units, unnest([a, b]) x(e), unnest([u, {_TURN.format('u')}]) y(f)),
    outside as (
        select gates, u, i from ends left join hops o on o.s = e and o.t = f left join hops b on b.s = f and b.t = e
        group by 1, 2, 3 having not bool_or(o.n is not null or b.n is not null or e = f)),
    outside_of as (select gates, list(u order by i) as outside from outside group by 1)"""


def _joined(c):
    return F.array_join(c, "|")


@query(
    f"{_CTE}{with_('trips').removeprefix('with ')}, {_NODES}, {_SHEET}"
    " select trip_id, before, corrected, array_to_string(list_filter([case when len(s.gates) > 0 then array_to_string(coalesce(o.ordered, s.gates), '|') end, case when len(stations) > 0 then array_to_string(stations, '|') end], lambda x: x is not null), ',') as after,"
    " array_to_string(list_filter([case when len(s.gates) > 0 then '门架' end, case when len(stations) > 0 then '收费站' end], lambda x: x is not null), ',') as kinds,"
    " array_to_string(list_filter(ids, lambda u: length(u) not in (14, 16)), '|') as unknown,"
    " array_to_string(list_filter(ids, lambda u: not ((length(u) = 16 and try_cast(substr(u, 12, 3) as int) % 9 <> 8) or (length(u) = 14 and try_cast(substr(u, 12, 3) as int) % 9 <> 7))), '|') as invalid,"
    " case when len(s.gates) > 1 then array_to_string(list_concat(list_filter([case when r.s <> s.gates[1] then 'first:' || r.s end, case when r.t <> s.gates[-1] then 'last:' || r.t end], lambda x: x is not null), list_transform(coalesce(o.turned, []), lambda u: 'unit:' || " + _TURN.format("u") + ")), '|') else '' end as turned,"
    " case when len(s.gates) > 1 then case when r.s is null then array_to_string(s.gates, '|') else coalesce(array_to_string(o.lost, '|'), '') end else '' end as lost,"
    " coalesce(array_to_string(x.outside, '|'), '') as outside"
    " from sheet s left join ordered o on o.gates = s.gates left join routes r on r.gates = s.gates left join outside_of x on x.gates = s.gates"
)
def dq9_checked_sheet(spark, sf_dir):
    """Each trip's field of units after each rule of the sheet checker."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"))
    valid = n.where("n % 9 <> 8").select(F.explode(F.array(_gate(F.col("n")), _gate(F.col("n"), "20"))).alias("unit"))
    valid = valid.unionByName(n.where("n % 9 <> 7").select(F.concat(F.lit(_STATION), F.lpad(F.col("n").cast("string"), 3, "0")).alias("unit")))
    found = sheets.checked_sheet(_sheet(spark, sf_dir), "trip_id", "units", gate_edges(spark, sf_dir), valid, TYPOS)
    turned = F.transform("turned", lambda t: F.concat(t["why"], F.lit(":"), t["new"]))
    return found.select("trip_id", "before", "corrected", "after", "kinds", _joined("unknown").alias("unknown"), _joined("invalid").alias("invalid"), _joined(turned).alias("turned"), _joined("lost").alias("lost"), _joined("outside").alias("outside"))


@query()
def l9_greedy_order(spark, sf_dir):
    """Each trip's units, in an order that has nothing to do with the road, as a traveller from its first one would take them."""
    t = trips(spark, sf_dir).where(F.size("path") > 1)
    gates = F.transform(F.array_distinct("path"), lambda u: _gate(u, F.when(u % 3 == 0, "20").otherwise("10")))
    journeys = t.select(F.col("trip_id").alias("key"), F.array(F.get(gates, F.lit(0))).alias("starts"), F.array_sort(gates).alias("units"))
    done = sheets.greedy_order(journeys, gate_edges(spark, sf_dir))
    shown = F.transform("ordered", lambda o: F.concat_ws(":", o["as"], o["how"]))
    return done.select(F.col("key").alias("trip_id"), F.element_at("starts", 1).alias("start"), _joined(shown).alias("ordered"))


@query(
    with_("trips") + ", p as (select trip_id, i::int - 1 as i, case when path[i] % 8 <> 6 then (100 + path[i] % 13)::double end as x, (30 + path[i] % 11)::double as y, len(path) as n from trips, unnest(range(1, len(path) + 1)) t(i)),"
    " three as (select trip_id, n, i, x - lead(x) over w as ax, y - lead(y) over w as ay, lead(x, 2) over w - lead(x) over w as bx, lead(y, 2) over w - lead(y) over w as \"by\" from p window w as (partition by trip_id order by i)),"
    " flats as (select trip_id, n, i, case when sqrt(ax * ax + ay * ay) * sqrt(bx * bx + \"by\" * \"by\") = 0 then false else degrees(acos(greatest(-1, least(1, (ax * bx + ay * \"by\") / (sqrt(ax * ax + ay * ay) * sqrt(bx * bx + \"by\" * \"by\")))))) >= 150 end as flat from three where ax is not null and bx is not null),"
    " marked as (select *, flat and not coalesce(lag(flat) over (partition by trip_id order by i), false) as starts from flats),"
    " runs as (select *, sum(starts::int) over (partition by trip_id order by i) as run from marked),"
    " ends as (select trip_id, run, min(i) as first, min(n) as n from runs where flat group by 1, 2),"
    " regions as (select e.trip_id, e.first, coalesce(min(r.i) + 2, e.n - 1) as last from ends e left join runs r on r.trip_id = e.trip_id and r.run = e.run and not r.flat group by e.trip_id, e.first, e.n)"
    " select trip_id, string_agg(first || '-' || last, '|' order by first) as regions from regions group by 1"
)
def dq12_backtrack_regions(spark, sf_dir):
    """Runs of flat corners of each trip that has some; the places of some units aren't known."""
    point = lambda u: F.struct(F.when(u % 8 != 6, (u % 13 + 100).cast("double")).alias("lon"), (u % 11 + 30).cast("double").alias("lat"))
    t = trips(spark, sf_dir).select("trip_id", path_report.backtrack_regions(F.transform("path", point)).alias("regions")).where(F.size("regions") > 0)
    return t.select("trip_id", _joined(F.transform("regions", lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string")))).alias("regions"))


@query(
    with_("trips") + ", fixes as (select trip_id, path as raw, list_filter(list_transform(path, lambda u: case when u % 5 = 4 then (u + 3) % 25 when u % 7 = 6 then null else u end), lambda u: u is not null) as fixed from trips)"
    " select trip_id, array_to_string(list_filter(range(0, len(fixed)), lambda i: list_contains(raw, fixed[i + 1])), '|') as anchors, array_to_string(list_filter(range(0, len(fixed)), lambda i: not list_contains(raw, fixed[i + 1])), '|') as inserted,"
    " array_to_string(list_filter(range(0, len(raw)), lambda i: not list_contains(fixed, raw[i + 1])), '|') as dropped, case when len(fixed) > 0 then len(fixed)::int - 1 end as last from fixes"
)
def dq12_unit_classes(spark, sf_dir):
    """What became of each unit when some were left out and others put in their place."""
    fixed = F.filter(F.transform("path", lambda u: F.when(u % 5 == 4, (u + 3) % 25).when(u % 7 == 6, None).otherwise(u)), lambda u: u.isNotNull())
    t = trips(spark, sf_dir).select("trip_id", "path", fixed.alias("fixed"))
    found = t.select("trip_id", path_report.unit_classes(F.col("path"), F.col("fixed")).alias("c"))
    listed = lambda c: _joined(F.col(f"c.{c}").cast("array<string>")).alias(c)
    return found.select("trip_id", listed("anchors"), listed("inserted"), listed("dropped"), F.col("c.end").alias("last"))


def _area_rows(spark, sf_dir):
    way = F.when(F.col("trip_id") % 3 == 0, sheets.BOTH_WAYS).when(F.col("trip_id") % 3 == 1, sheets.COUNTED_WAY).otherwise("east")
    return trips(spark, sf_dir).select("trip_id", F.concat(F.lit("R"), (F.col("enid") % 5).cast("string")).alias("road"), way.alias("direction"), F.col("path").alias("units"), F.date_format("entime", "yyyy-MM").alias("month"), "vehicle_type")


def _area_sections(spark, sf_dir):
    n = F.col("n_nationkey")
    each = table(spark, sf_dir, "nation").select(n, F.explode(F.array(*(F.lit(i) for i in range(5)))).alias("r"))
    units = F.when(n % 3 == 0, F.array(n, (n + 7) % 25)).otherwise(F.array(n))
    return each.select(F.concat(F.lit("R"), F.col("r").cast("string")).alias("road"), F.concat(F.lit("S"), (n % 20).cast("string")).alias("section"), F.when(n % 2 == 0, sheets.COUNTED_WAY).otherwise("east").alias("direction"), n.alias("nth"), units.alias("units"))


_AREA = """
    areas as (
        select trip_id, 'R' || enid % 5 as road, case trip_id % 3 when 2 then 'east' else '西安方向' end as direction, path as units, strftime(entime, '%Y-%m') as month, vehicle_type from trips),
    sections as (
        select 'R' || r as road, 'S' || n_nationkey % 20 as section, case when n_nationkey % 2 = 0 then '西安方向' else 'east' end as direction, n_nationkey as nth,
            case when n_nationkey % 3 = 0 then [n_nationkey, (n_nationkey + 7) % 25] else [n_nationkey] end as units from nation, range(5) x(r)),
    hits as (
        select trip_id, section, min(nth) as nth from areas a join sections s on a.road = s.road and a.direction = s.direction and list_has_all(a.units, s.units) group by 1, 2),
    matched as (select trip_id, list(section order by nth) as sections from hits group by 1)"""


@query(with_("trips") + f", {_AREA} select trip_id, array_to_string(sections, '|') as sections from matched")
def dq10_sections_inside(spark, sf_dir):
    found = sheets.sections_inside(_area_rows(spark, sf_dir), _area_sections(spark, sf_dir), "trip_id")
    return found.select("trip_id", _joined("sections").alias("sections"))


_PLANS = "plans as (select 'R' || n_nationkey % 5 as road, printf('2027-%02d', n_nationkey % 12 + 1) as month, n_nationkey % 5 + 1 as vehicle_type, 'P' || n_nationkey % 3 as scheme, n_nationkey % 2 as situation from nation)"
_WORKS = "works as (select 'R' || r as road, 'P' || p as scheme, s as situation, 'S' || n as section, case (n + r + p + s) % 3 when 0 then '所有车辆正常通行' when 1 then 'lane' else 'full' end as type_name from range(5) a(r), range(3) b(p), range(2) c(s), range(20) d(n))"


def _plans(spark, sf_dir):
    n = F.col("n_nationkey")
    month = F.concat(F.lit("2027-"), F.lpad((n % 12 + 1).cast("string"), 2, "0"))
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("R"), (n % 5).cast("string")).alias("road"), month.alias("month"), (n % 5 + 1).alias("vehicle_type"), F.concat(F.lit("P"), (n % 3).cast("string")).alias("scheme"), (n % 2).alias("situation"))


@query(
    with_("trips") + f", {_AREA}, {_PLANS} select trip_id, a.month as month_of_row, p.month, scheme, situation::int as situation from areas a join plans "
    f"p on a.road = p.road and a.vehicle_type = p.vehicle_type and substr(a.month, 6) = substr(p.month, 6)"
)
def p14_month_match(spark, sf_dir):
    """Each trip with the plans of its road and vehicle type in the same month of any year."""
    found = sheets.rows_of_plans(_area_rows(spark, sf_dir), _plans(spark, sf_dir), ["road", "vehicle_type"])
    return found.select("trip_id", "month_of_row", "month", "scheme", F.col("situation").cast("int").alias("situation"))


@query(
    with_("trips") + f", {_AREA}, {_PLANS}, {_WORKS}, planned as (select trip_id, a.road, p.month, scheme, situation from areas a join plans p on a.road = p.road and a.vehicle_type = p.vehicle_type and substr(a.month, 6) = substr(p.month, 6)),"
    " each as (select p.trip_id, p.scheme, p.situation, s.section, i, type_name from planned p join matched m on p.trip_id = m.trip_id, unnest(range(1, len(m.sections) + 1)) x(i), unnest([m.sections[i]]) s(section), works w where w.road = p.road and w.scheme = p.scheme and w.situation = p.situation and w.section = s.section and type_name <> '所有车辆正常通行'),"
    " labels as (select trip_id, scheme, situation, case when count(distinct type_name) = 1 then min(type_name) else string_agg(section || '：' || type_name, '，' order by i) end as label from each group by 1, 2, 3)"
    " select p.trip_id, p.scheme, p.situation::int as situation, coalesce(l.label, '所有车辆正常通行') as label from planned p left join labels l on l.trip_id = p.trip_id and l.scheme = p.scheme and l.situation = p.situation"
)
def dq10_plan_labels(spark, sf_dir):
    """What is done on each planned trip's sections."""
    rows = sheets.rows_of_plans(_area_rows(spark, sf_dir), _plans(spark, sf_dir), ["road", "vehicle_type"])
    rows = rows.withColumn("id", F.concat_ws("|", F.col("trip_id").cast("string"), "scheme", F.col("situation").cast("string")))
    n = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("n"))
    works = n.select("n", F.explode(F.array(*(F.lit(i) for i in range(5)))).alias("r")).select("*", F.explode(F.array(*(F.lit(i) for i in range(3)))).alias("p")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("situation"))
    kind = (F.col("n") + F.col("r") + F.col("p") + F.col("situation")) % 3
    works = works.select(F.concat(F.lit("R"), F.col("r").cast("string")).alias("road"), F.concat(F.lit("P"), F.col("p").cast("string")).alias("scheme"), "situation", F.concat(F.lit("S"), F.col("n").cast("string")).alias("section"), F.when(kind == 0, sheets.OPEN_TO_ALL).when(kind == 1, "lane").otherwise("full").alias("type_name"))
    inside = sheets.sections_inside(_area_rows(spark, sf_dir), _area_sections(spark, sf_dir), "trip_id")
    matched = rows.select("id", "trip_id").join(inside, "trip_id").select("id", "sections")
    return sheets.plan_labels(rows, matched, works, "id").select("trip_id", "scheme", F.col("situation").cast("int").alias("situation"), "label")
