"""Sheets of works and pairs, as people keep them: units checked and put in order, months matched, areas matched to sections.

A unit of the toll network is a gate of a direction (16 characters; the last two are 10 or 20) or a station (14). Numbers of
units on best paths are looked up for distinct pairs only, by a search a source; the sheets themselves are joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import reversed_unit
from ..shared import stored
from .graph import RoadGraph, graph_of, shared_graph, shortest_paths

#: Kinds of an end, names of works and of directions as results carry them. Fixed values.
GATE, STATION = "门架", "收费站"
OPEN_TO_ALL = "所有车辆正常通行"
BOTH_WAYS, COUNTED_WAY = "双向", "西安方向"
GATE_LENGTH, STATION_LENGTH = 16, 14


def unit_list(text: Column) -> Column:
    """Ids of a text, parted by `|`, commas, line ends or tabs; blanks trimmed, empty ones dropped; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), ",\n\r\t", "||||"), r"\|")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def without_typos(text: Column, typos: dict[str, str]) -> Column:
    return reduce(lambda t, fix: F.replace(t, F.lit(fix[0]), F.lit(fix[1])), typos.items(), text)


def of_length(units: Column, n: int) -> Column:
    return F.filter(units, lambda u: F.length(u) == n)


def unit_kinds(gates: Column, stations: Column) -> Column:
    """`门架`, `收费站`, both joined by a comma, or an empty text."""
    named = F.array(F.when(F.size(gates) > 0, GATE), F.when(F.size(stations) > 0, STATION))
    return F.array_join(F.array_compact(named), ",")


def units_between(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, target, units): the number of units on the best path of each distinct pair of two that has one."""
    found = shortest_paths(pairs.where("source <> target"), edges)
    return found.select("source", "target", F.size("path").alias("units"))


def route_order(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """lists (key, units: two or more) with ordered, turned (struct old, new, why) and lost: units in the order in which a route meets them.

    The route leads from the first unit to the last, each of them or the opposite direction's, whichever pair has the fewest units
    between (of equally many: own first, then the first one's own). Units come by their place on the way from its start; one that isn't reached
    counts as the opposite direction's if that is, else it comes last, in its old order (lost). Where no pair is joined, the list
    stays, and all of it is lost. A unit counts as its own opposite where it has none.
    """
    first, last = F.element_at("units", 1), F.element_at("units", -1)
    other = lambda u: F.coalesce(reversed_unit(u), u)
    ways = [F.struct(F.lit(i).alias("way"), a.alias("source"), b.alias("target")) for i, (a, b) in enumerate(((first, last), (first, other(last)), (other(first), last), (other(first), other(last))))]
    ends = lists.select("key", F.explode(F.array(*ways)).alias("e")).select("key", "e.*")
    near = stored(units_between(ends.select("source", "target"), edges), "sheet-ends")  # its size is known to the join
    best = ends.join(near, ["source", "target"]).groupBy("key").agg(F.min(F.struct("units", "way", "source", "target")).alias("route"))
    placed = stored(lists.join(best.select("key", F.col("route.source").alias("start"), F.col("route.target").alias("end")), "key", "left"), "sheet-routes")
    each = placed.where("start is not null").select("key", "start", F.posexplode("units").alias("i", "unit")).withColumn("turn", reversed_unit(F.col("unit")))
    asked = each.select(F.col("start").alias("source"), F.explode(F.array_compact(F.array("unit", "turn"))).alias("target"))
    far = stored(units_between(asked, edges), "sheet-places")
    at = lambda c, name: far.select(F.col("source").alias("start"), F.col("target").alias(c), F.col("units").alias(name))
    known = each.join(at("unit", "own"), ["start", "unit"], "left").join(at("turn", "turned"), ["start", "turn"], "left")
    own = F.when(F.col("unit") == F.col("start"), 1).otherwise(F.col("own"))
    place = F.coalesce(own, F.col("turned"), F.lit(1 << 30))
    goes = F.when(own.isNull() & F.col("turned").isNotNull(), F.col("turn")).otherwise(F.col("unit"))
    one = F.struct(place.alias("place"), F.col("i").alias("i"), goes.alias("goes"), F.col("unit").alias("unit"))
    row = known.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("row"))
    out = placed.join(row, "key", "left")
    change = lambda old, new, why: F.when(old != new, F.struct(old.alias("old"), new.alias("new"), F.lit(why).alias("why")))
    inner = F.transform(F.array_sort(F.filter("row", lambda r: r["goes"] != r["unit"]), lambda a, b: a["i"] - b["i"]), lambda r: F.struct(r["unit"].alias("old"), r["goes"].alias("new"), F.lit("unit").alias("why")))
    turned = F.concat(F.array_compact(F.array(change(first, F.col("start"), "first"), change(last, F.col("end"), "last"))), F.coalesce(inner, F.array().cast("array<struct<old:string,new:string,why:string>>")))
    lost = F.transform(F.filter("row", lambda r: r["place"] == 1 << 30), lambda r: r["unit"])
    return out.select("key", "units", F.coalesce(F.transform("row", lambda r: r["goes"]), "units").alias("ordered"), F.coalesce(turned, F.array()).alias("turned"), F.coalesce(lost, "units").alias("lost"))


def outside_units(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, outside) of lists (key, units) that have some: inner units that no path joins to either end, in either direction, nor their opposites."""
    ends = lists.select("key", F.element_at("units", 1).alias("a"), F.element_at("units", -1).alias("b"), F.posexplode(F.slice("units", F.lit(2), F.greatest(F.size("units") - 2, F.lit(0)))).alias("i", "unit"))
    both = ends.select("key", "i", "unit", F.explode(F.array_distinct(F.array("a", "b"))).alias("end"))
    both = both.select("key", "i", "unit", "end", F.explode(F.array_compact(F.array("unit", reversed_unit(F.col("unit"))))).alias("form"))
    ways = both.select("key", "i", "unit", F.explode(F.array(F.struct(F.col("end").alias("source"), F.col("form").alias("target")), F.struct(F.col("form").alias("source"), F.col("end").alias("target")))).alias("w")).select("key", "i", "unit", "w.*")
    joined = stored(units_between(ways.select("source", "target"), edges), "sheet-joined")
    found = ways.join(joined, ["source", "target"], "left").groupBy("key", "i", "unit").agg(F.max(F.col("units").isNotNull() | (F.col("source") == F.col("target"))).alias("there"))
    return found.where("not there").groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "unit"))), lambda x: x["unit"]).alias("outside"))


def checked_sheet(rows: DataFrame, key: str, field: str, edges: DataFrame, valid: DataFrame, typos: dict[str, str] | None = None) -> DataFrame:
    """A field of units after each rule, before and after: one row a key.

    Rules in turn. Identity: known typing errors are replaced (`corrected`); ids that are neither gate nor station are dropped
    (`unknown`), those that valid (column unit) lacks are named (`invalid`). Kind: gates and stations are told apart by length (`kinds`).
    Order: two gates or more are put in route order (`turned`, `lost`). Membership: gates inside the list that no path joins to its ends (`outside`).
    `after` has the gates, joined by `|`, a comma and the stations; a null or blank field stays as it is. Equal fields are looked at once.
    """
    texts = rows.select(F.col(field).alias("before")).where("before is not null").distinct()
    units = unit_list(F.col("corrected"))
    texts = texts.withColumn("corrected", without_typos(F.col("before"), typos or {})).withColumn("all", units)
    texts = texts.select("before", "corrected", "all", of_length(F.col("all"), GATE_LENGTH).alias("gates"), of_length(F.col("all"), STATION_LENGTH).alias("stations"), F.filter("all", lambda u: ~F.length(u).isin(GATE_LENGTH, STATION_LENGTH)).alias("unknown"))
    texts = stored(texts.withColumns({"list": F.array_join("gates", "|"), "text_id": F.monotonically_increasing_id()}), "sheet-texts")
    # numbers, not texts, are the keys of what is exploded
    lists = stored(texts.where(F.size("gates") > 1).groupBy("list").agg(F.first("gates").alias("units")).withColumn("key", F.monotonically_increasing_id()), "sheet-lists")
    order, outside = route_order(lists.select("key", "units"), edges), outside_units(lists.select("key", "units"), edges)
    of_list = lists.select("key", "list").join(order.drop("units"), "key", "left").join(outside, "key", "left").drop("key")
    named = texts.select("text_id", F.posexplode("all").alias("i", "unit")).join(valid.select("unit").distinct().withColumn("_ok", F.lit(True)), "unit", "left").where("_ok is null")
    invalid = named.groupBy("text_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "unit"))), lambda x: x["unit"]).alias("invalid"))
    out = texts.join(invalid, "text_id", "left").join(of_list, "list", "left")
    ordered = F.coalesce("ordered", "gates")
    sides = F.array(F.when(F.size(ordered) > 0, F.array_join(ordered, "|")), F.when(F.size("stations") > 0, F.array_join("stations", "|")))
    none = F.array().cast("array<string>")
    out = out.select(
        "before", "corrected", F.when(F.trim("corrected") == "", F.col("corrected")).otherwise(F.array_join(F.array_compact(sides), ",")).alias("after"), unit_kinds(F.col("gates"), F.col("stations")).alias("kinds"),
        "unknown", F.coalesce("invalid", none).alias("invalid"), F.coalesce("turned", F.array().cast("array<struct<old:string,new:string,why:string>>")).alias("turned"), F.coalesce("lost", none).alias("lost"), F.coalesce("outside", none).alias("outside"),
    )
    return rows.select(key, F.col(field).alias("before")).join(out, "before", "left").withColumn("changed", ~F.col("before").eqNullSafe(F.col("after")))


def nearest_next(graph: RoadGraph, starts: Sequence, units: Sequence, turn, most: int = 100, held: dict | None = None) -> list[tuple]:
    """(unit, as, how) in the order in which a traveller takes the units: always the nearest to where they are.

    starts: the units of the start, of which the last is where the journey begins; none of them is taken again. Near is what has the fewest units
    on the best path: from the place, or from its opposite, to the unit or to its opposite (`as`: the form that is
    nearest), ahead; or from the unit to the place, back (`how`). Of equally near ways those ahead win, with the unit's own
    form first; among ways back those to the place's opposite, then those of the unit's opposite. Of equally near units the first in
    the list is taken, and up to two units count as equally near. A way ahead moves the place to where it ends, a way back doesn't.
    Units without a way of fewer than `most` units come last (`lost`). held: trees that are kept from call to call.
    """
    trees = {} if held is None else held

    def ahead(a) -> dict:
        if ("ahead", a) not in trees:
            trees["ahead", a] = {b: len(path) for b, (_, path) in graph.tree(a).items()}
        return trees["ahead", a]

    def between(a, b) -> int:
        return most if a is None or b is None else min(most, ahead(a).get(b, most) if a in graph.next or a == b else most)

    def nearest(unit, place) -> tuple:
        """(units, whether back, two more that order equal ones, form)."""
        forms, places = ((unit, 0), (turn(unit), 1)), ((place, 0), (turn(place), 1))
        ways = [(between(p, f), 0, i, 0, f) for f, i in forms for p, _ in places] + [(between(f, p), 1, 1 - j, 1 - i, f) for f, i in forms for p, j in places]
        return min((w for w in ways if w[4] is not None), key=lambda w: w[:4])

    left = [u for u in dict.fromkeys(units) if u not in starts]
    place, out = starts[-1], []
    while left:
        found = [(*nearest(u, place), n) for n, u in enumerate(left)]
        best = min(found, key=lambda w: (max(w[0], 2), w[5]))
        if best[0] >= most:
            return out + [(u, u, "lost") for u in left]
        unit = left.pop(best[5])
        out.append((unit, best[4], "back" if best[1] else "ahead"))
        if not best[1]:
            place = best[4]
    return out


def greedy_order(journeys: DataFrame, edges: DataFrame, most: int = 100) -> DataFrame:
    """journeys (key, starts, units: arrays of ids) with `ordered`: structs unit, as, how of nearest_next. Empty starts leave the order as it was, all lost.

    Each different pair of starts and units is ordered once; a worker keeps the trees of the places that it meets.
    """
    shared = shared_graph(edges)

    def turn(u):
        return u[:-2] + {"10": "20", "20": "10"}[u[-2:]] if u[-2:] in ("10", "20") else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph, held = graph_of(shared), {}
        for batch in batches:
            ordered = []
            for starts, units in zip(batch["starts"], batch["units"], strict=True):
                found = nearest_next(graph, list(starts), list(units), turn, most, held) if len(starts) else [(u, u, "lost") for u in dict.fromkeys(units)]
                ordered.append([{"unit": u, "as": f, "how": h} for u, f, h in found])
            yield batch[["key"]].assign(ordered=ordered)

    kind = dict(journeys.dtypes)["key"]
    each = journeys.select("key", *(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("starts", "units"))).withColumn("_same", F.xxhash64("starts", "units"))
    one = each.groupBy("_same", "starts", "units").agg(F.min("key").alias("key"))
    done = one.select("key", "starts", "units").mapInPandas(run, f"key {kind}, ordered array<struct<unit:string,as:string,how:string>>")
    named = one.select(F.col("key").alias("_one"), "_same", F.col("starts").alias("_starts"), F.col("units").alias("_units")).join(done.withColumnRenamed("key", "_one"), "_one")
    same = (each["_same"] == named["_same"]) & (each["starts"] == named["_starts"]) & (each["units"] == named["_units"])
    return each.join(named, same).select(each["key"], each["starts"], each["units"], "ordered")


def month_of_year(month: Column) -> Column:
    """The month of a yyyy-MM, whatever the year."""
    return F.substring(month, 6, 2)


def rows_of_plans(rows: DataFrame, plans: DataFrame, on: Sequence[str], month: str = "month") -> DataFrame:
    """Each row once for each plan of the same keys and month of the year, with the plan's columns; the plan's month takes the row's place (kept as {month}_of_row)."""
    few = plans.withColumn("_month", month_of_year(F.col(month)))
    mine = rows.withColumnRenamed(month, f"{month}_of_row").withColumn("_month", month_of_year(F.col(f"{month}_of_row")))
    return mine.join(few, [*on, "_month"]).drop("_month")


def sections_inside(rows: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """(key, sections): names of the sections whose units are all among the row's, in the sections' order.

    rows: key, road, direction, units; sections: road, section, direction, nth (their order), units. Both directions count as one of them. Units that a row and
    a section share are found by unit and counted; a pair that shares none never meets.
    """
    way = F.when(F.col("direction") == BOTH_WAYS, COUNTED_WAY).otherwise(F.col("direction"))
    mine = rows.select(key, "road", way.alias("direction"), F.explode(F.array_distinct("units")).alias("unit"))
    theirs = sections.select("road", "direction", "section", "nth", F.size(F.array_distinct("units")).alias("size"), F.explode(F.array_distinct("units")).alias("unit"))
    shared = mine.join(theirs, ["road", "direction", "unit"]).groupBy(key, "section", "nth", "size").agg(F.count("*").alias("shared")).where("shared = size")
    one = shared.groupBy(key, "section").agg(F.min("nth").alias("nth"))
    return one.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "section"))), lambda x: x["section"]).alias("sections"))


def plan_labels(rows: DataFrame, matched: DataFrame, works: DataFrame, key: str) -> DataFrame:
    """rows (key, road, scheme, situation) with `label`: what is done on the matched sections (key, sections).

    works: road, scheme, situation, section, type_name (of a section with several the largest). Sections that stay open to all are left out; without any other the label says that. One type is named alone, several
    each with its section.
    """
    each = matched.select(key, F.posexplode("sections").alias("i", "section"))
    named = rows.select(key, "road", "scheme", "situation").join(each, key).join(works.groupBy("road", "scheme", "situation", "section").agg(F.max("type_name").alias("type_name")), ["road", "scheme", "situation", "section"])
    closed = named.where(F.col("type_name") != OPEN_TO_ALL).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("i", "section", "type_name"))).alias("of"))
    types = F.array_distinct(F.transform("of", lambda x: x["type_name"]))
    label = F.when(F.size(types) == 1, F.get(types, F.lit(0))).otherwise(F.array_join(F.transform("of", lambda x: F.concat(x["section"], F.lit("："), x["type_name"])), "，"))
    return rows.join(closed.select(key, label.alias("label")), key, "left").withColumn("label", F.coalesce("label", F.lit(OPEN_TO_ALL)))
