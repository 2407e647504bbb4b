"""Repair of recorded paths against the road graph, with their times."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import RoadGraph, graph_of, shared_graph

#: Ids shorter than this are stations, not units.
UNIT_ID_LENGTH = 16
#: Reasons of a change, as results carry them. Fixed values.
TURNED, TURNED_AND_FILLED = "reverse_fix", "reverse_path_fill"


def opposite(unit: str) -> str | None:
    stem, end = unit[:-2], unit[-2:]
    return {"10": stem + "20", "20": stem + "10"}.get(end)


@dataclass
class Plan:
    """A repaired path, whatever the clock said: units as (unit, at, nth, of), changes as (place, from, to, reason), the last gap that stays.

    of 0: the unit has the time at place `at` of the record (-1: entry, length of the path: exit). Else it is the nth of of - 1 units that
    lie between the unit before them and that time, in equal steps.
    """

    units: list[tuple[str, int, int, int]] = field(default_factory=list)
    changes: list[tuple[int, str, str, str]] = field(default_factory=list)
    error: str | None = None
    timed: bool = True


def judged(graph: RoadGraph, before: str, unit: str, after: str) -> tuple[str, tuple]:
    """What becomes of a unit between two others, and the way to it: keep, fill (a way to the unit), turn (its opposite follows), reach (the shorter way to it or its opposite) or stuck."""
    if graph.has_edge(before, unit):
        return "keep", ()
    way_to = lambda x: (graph.shortest(before, x) or (0, ()))[1] if x else ()
    if graph.has_edge(unit, after):
        kind, ways = "fill", [way_to(unit)]
    elif (back := opposite(unit)) and graph.has_edge(before, back):
        return "turn", (before, back)
    else:
        kind, ways = "reach", [way_to(unit), way_to(back)]
    way = min(filter(None, ways), key=len, default=())
    return (kind, way) if len(way) > 1 else ("stuck", ())


def planned(units: Sequence[str], known: Sequence[bool] | None, graph: RoadGraph, enid: str = "", exid: str = "") -> Plan:
    """The repair of a recorded path. known: whether entry, each unit and exit have a time; None: the record has no times.

    Entry and exit station are stops like the units. Each stop but the first and the last is judged between the stop behind and the next
    one. It is kept or its opposite takes its place; or the best way to it is filled in, to the shorter of both ends where the road
    leads on from neither; what can't be reached is kept and named. After a way that was filled towards the unit itself, with
    no edge on from it, the next stop is the one behind, and isn't put down. A unit is put down once. Filled units need a time on
    both sides if the record has times. Stations go again from both ends. A record of fewer than three stops stays, without its ends.
    """
    n, timed = len(units), known is not None
    stops = deque((u, i) for i, u in enumerate(units))
    if enid and (not stops or stops[0][0] != enid):
        stops.appendleft((enid, -1))
    if exid and (not stops or stops[-1][0] != exid):
        stops.append((exid, n))
    if len(stops) < 3:
        kept = [s for s in stops if not (enid or exid) or s[0] not in (enid, exid)]
        return Plan([(u, i, 0, 0) for u, i in kept or [(u, i) for i, u in enumerate(units)]], timed=timed and bool(kept))
    plan, met, has = Plan(timed=timed), set(), (lambda i: known[i + 1]) if timed else (lambda i: True)
    clock = True  # whether the last unit put down has a time

    def put(unit: str, at: int) -> bool:
        if unit in met:
            return clock
        met.add(unit)
        plan.units.append((unit, at, 0, 0))
        return has(at)

    behind, moves = stops.popleft(), 0
    clock = put(*behind)
    while len(stops) > 1:
        (unit, at), (after, at_after) = stops[0], stops[1]
        kind, way = judged(graph, behind[0], unit, after)
        end = way[-1] if way else unit
        if end != unit:
            plan.changes.append((moves + 1, unit, end, TURNED if kind == "turn" else TURNED_AND_FILLED))
        if kind == "turn":
            clock = put(end, at)
            stops[0] = end, at
            continue
        if kind in ("keep", "stuck"):
            clock = put(unit, at)
        else:
            right = at_after if kind == "reach" and end == after else at
            new = [u for u in dict.fromkeys(way[1:]) if u not in met]
            if new and clock and has(right):
                met.update(new)
                plan.units += [(u, right, i, len(new) + 1) for i, u in enumerate(new, 1)]
        if kind == "stuck":
            plan.error = f"no_way:{behind[0]}>{unit}"
        behind, moves = stops.popleft(), moves + 1
        if kind == "reach" and end == after:
            stops.popleft()
        elif kind == "reach" and end == unit:
            behind = stops.popleft()
    for stop in (behind, *stops):
        clock = put(*stop)
    if enid and len(enid) < UNIT_ID_LENGTH and plan.units[:1] and plan.units[0][0] == enid:
        del plan.units[0]
    if exid and len(exid) < UNIT_ID_LENGTH and plan.units and plan.units[-1][0] == exid:
        del plan.units[-1]
    return plan


def planned_times(plan: Column, times: Column, entime: Column, extime: Column, length: Column) -> Column:
    """Times of a plan's units, in one fold: recorded ones, or equal steps from the last one, cut to seconds."""
    recorded = lambda i: F.when(i == -1, entime).when(i == length, extime).otherwise(F.get(times, i))

    def between(left: Column, right: Column, nth: Column, of: Column) -> Column:
        at = left + (right - left) * (nth.cast("double") / of)
        return at - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), at) % 1)

    def step(so_far: Column, u: Column) -> Column:
        left = F.when(u["nth"] == 1, F.get(so_far["done"], F.size(so_far["done"]) - 1)).otherwise(so_far["left"])
        at = F.when(u["of"] == 0, recorded(u["at"])).otherwise(between(left, recorded(u["at"]), u["nth"], u["of"]))
        return F.struct(F.array_append(so_far["done"], at).alias("done"), left.alias("left"))

    start = F.struct(F.array().cast("array<timestamp_ntz>").alias("done"), F.lit(None).cast("timestamp_ntz").alias("left"))
    return F.aggregate(plan, start, step, lambda x: x["done"])


#: Different records whose plans a task remembers, and pairs of units whose way it does.
HELD = 65_536


def repair_intervals(records: DataFrame, edges: DataFrame, id_col: str, reverse_penalty: float | None = None) -> DataFrame:
    """records: id, path, times, enid, exid, entime, extime. Returns id, path, times, changes (place, from, to, reason), error.

    A plan depends on the units, the ends and on which times are known, not on the times: a task plans each of these once while it
    remembers it (HELD), and times follow by column. The graph is broadcast (its size is checked); nothing is shuffled. A null path is
    an empty one, null or blank ends are none, null times (or none) make a record without times.
    """
    shared = shared_graph(edges, reverse_penalty)
    kind = dict(records.dtypes)[id_col]
    unit = "array<struct<unit:string,at:int,nth:int,of:int>>"
    schema = f"{id_col} {kind}, _times array<timestamp_ntz>, _entime timestamp_ntz, _extime timestamp_ntz, _n int, _units {unit}, _timed boolean, changes array<struct<place:int,from:string,to:string,reason:string>>, error string"
    plan = pa.struct([("_units", pa.list_(pa.struct([("unit", pa.string()), ("at", pa.int32()), ("nth", pa.int32()), ("of", pa.int32())]))), ("_timed", pa.bool_()), ("changes", pa.list_(pa.struct([("place", pa.int32()), ("from", pa.string()), ("to", pa.string()), ("reason", pa.string())]))), ("error", pa.string())])

    def run(batches):
        graph, held = graph_of(shared), {}
        graph.shortest = lru_cache(HELD)(graph.shortest)

        def of(path, enid, exid, mask):
            key = (*path, None, enid, exid, mask)
            if key not in held:
                if len(held) >= HELD:
                    held.clear()
                found = planned(path, None if mask is None else [c == "1" for c in mask], graph, enid, exid)
                held[key] = {
                    "_units": [dict(zip(("unit", "at", "nth", "of"), u, strict=True)) for u in found.units], "_timed": found.timed,
                    "changes": [dict(zip(("place", "from", "to", "reason"), c, strict=True)) for c in found.changes], "error": found.error,
                }
            return held[key]

        for batch in batches:
            made = pa.array([of(*x) for x in zip(*(batch[c].to_pylist() for c in ("_path", "_enid", "_exid", "_known")), strict=True)], plan)
            kept = [batch[c] for c in (id_col, "_times", "_entime", "_extime", "_n")]
            yield pa.RecordBatch.from_arrays([*kept, *made.flatten()], names=[id_col, "_times", "_entime", "_extime", "_n", "_units", "_timed", "changes", "error"])

    path, times = F.coalesce(F.col("path").cast("array<string>"), F.array().cast("array<string>")), F.col("times").cast("array<timestamp_ntz>")
    ends = [F.col(c).cast("timestamp_ntz") for c in ("entime", "extime")]
    flag = lambda t: F.when(t.isNotNull(), "1").otherwise("0")
    known = F.when(F.size(times) > 0, F.concat(flag(ends[0]), F.array_join(F.transform(path, lambda _, i: flag(F.get(times, i))), ""), flag(ends[1])))
    asked = records.select(id_col, path.alias("_path"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in ("enid", "exid")), known.alias("_known"), times.alias("_times"), ends[0].alias("_entime"), ends[1].alias("_extime"), F.size(path).alias("_n"))
    found = asked.mapInArrow(run, schema)
    at = F.when(F.col("_timed"), planned_times(F.col("_units"), F.col("_times"), F.col("_entime"), F.col("_extime"), F.col("_n"))).otherwise(F.array().cast("array<timestamp_ntz>"))
    return found.select(id_col, F.transform("_units", lambda u: u["unit"]).alias("path"), at.alias("times"), "changes", "error")


def rejected(repaired: DataFrame) -> DataFrame:
    """Records whose repair failed somewhere."""
    return repaired.where(F.col("error").isNotNull())
