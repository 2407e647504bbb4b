"""Repairs of records against the rules, told once more and plainly."""

import itertools
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from roadweave.functions import paths
from roadweave.operators import graph, path_repair, repair


def _best(edges, a, b):
    """Fewest miles, then fewest units, then what sorts first, by trying all simple paths."""
    found = []

    def walk(path, cost):
        if path[-1] == b:
            found.append((cost, len(path), path))
            return
        for (x, y), m in edges.items():
            if x == path[-1] and y not in path:
                walk((*path, y), cost + m)

    walk((a,), 0)
    return min(found)[2] if found else ()


def _by_rule(edges, units, times, enid, exid, entime, extime):
    """One stop after the other, written as what happens to the list of stops that are left."""
    timed = bool(times)
    stops = list(zip(units, (times or []) + [None] * len(units), strict=False))
    stops = ([(enid, entime)] if enid and (not stops or stops[0][0] != enid) else []) + stops
    stops = stops + ([(exid, extime)] if exid and (not stops or stops[-1][0] != exid) else [])
    if len(stops) <= 2:
        kept = [s for s in stops if s[0] not in (enid, exid)] if enid or exid else stops
        return ([s[0] for s in kept] or list(units), [s[1] for s in kept] if timed else [], None)
    turn = lambda u: u[:-2] + {"10": "20", "20": "10"}[u[-2:]] if u[-2:] in ("10", "20") else None
    out, error = [stops[0]], None
    have = lambda u: u in [o[0] for o in out]

    def put(stop):
        if not have(stop[0]):
            out.append(stop)

    def fill(way, right):
        new = [u for u in way if not have(u)]
        left = out[-1][1]
        for i, u in enumerate(new, 1):
            if not timed:
                out.append((u, None))
            elif left is not None and right is not None:
                at = left + (right - left) * i / (len(new) + 1)
                out.append((u, at.replace(microsecond=0)))

    while len(stops) > 2:
        (a, _), (b, tb), (c, tc) = stops[:3]
        if (a, b) in edges:
            put((b, tb))
            stops = stops[1:]
            continue
        if (b, c) in edges:
            way, where = _best(edges, a, b), tb
        elif turn(b) and (a, turn(b)) in edges:
            stops[1] = (turn(b), tb)
            continue
        else:
            ways = [w for w in (_best(edges, a, b), _best(edges, a, turn(b)) if turn(b) else ()) if w]
            way = min(ways, key=len) if ways else ()
            where = tc if way and way[-1] == c else tb
        if len(way) < 2:
            put((b, tb))
            error = (a, b)
            stops = stops[1:]
            continue
        fill(way[1:], where)
        skipped = (b, c) not in edges and (2 if way[-1] == b and way[-1] != c else 1)
        stops = [stops[1], *stops[3:]] if (b, c) not in edges and way[-1] == c else stops[skipped or 1 :]
    for s in stops:
        put(s)
    if enid and len(enid) < 16 and out[0][0] == enid:
        out = out[1:]
    if exid and len(exid) < 16 and out and out[-1][0] == exid:
        out = out[:-1]
    return [o[0] for o in out], [o[1] for o in out] if timed else [], error


def test_intervals_by_rule(spark):
    rng = random.Random(3)
    name = lambda i, way: f"G000000000000{i}{way}"
    nodes = [name(i, w) for i in range(5) for w in (10, 20)] + ["S1", "S2"]
    edges = {(a, b): rng.randrange(1, 5) for a, b in itertools.permutations(nodes, 2) if rng.random() < 0.16}
    rows = []
    for i in range(400):
        n = rng.randrange(0, 7)
        units = [rng.choice(nodes) for _ in range(n)]
        at = datetime(2026, 3, 1) + timedelta(seconds=rng.randrange(86400))
        times = None if rng.random() < 0.2 else [None if rng.random() < 0.2 else at + timedelta(seconds=rng.randrange(4000)) for _ in range(max(0, n - (rng.random() < 0.1)))]
        end = lambda s: rng.choice([None, "", s, rng.choice(nodes)])
        rows.append((i, units, times, end("S1"), end("S2"), rng.choice([None, at]), rng.choice([None, at + timedelta(seconds=5000)])))
    rows.append((900, None, None, None, None, None, None))
    df = spark.createDataFrame(rows, "id int, path array<string>, times array<timestamp_ntz>, enid string, exid string, entime timestamp_ntz, extime timestamp_ntz")
    e = spark.createDataFrame([(a, b, m) for (a, b), m in edges.items()], "src string, dst string, miles int")
    found = {r.id: r for r in repair.repair_intervals(df, e, "id").collect()}
    assert found[900].path == [] and found[900].times == []
    for i, units, times, enid, exid, entime, extime in rows[:400]:
        path, at, error = _by_rule(edges, units, times, enid or "", exid or "", entime, extime)
        assert (i, found[i].path, found[i].times) == (i, path, at)
        assert found[i].error == (f"no_way:{error[0]}>{error[1]}" if error else None)


def test_section_numbers_by_rule():
    """The shorter of two readings as pairs, of which each that equals the one kept before it goes."""
    rng = random.Random(2)
    once = lambda x: [v for v, _ in itertools.groupby(x)]

    def reading(x, lone):
        pairs = ([(x[0],)] if lone else []) + [tuple(x[i : i + 2]) for i in range(lone, len(x), 2)]
        out = []
        while pairs:
            head = pairs.pop(0)
            out += head
            # an equal neighbour goes, once; a lone first or last number equals no pair, but a lone one like it
            if pairs and pairs[0] == head and (len(head) == 2):
                pairs.pop(0)
        return out

    for _ in range(2000):
        numbers = [rng.randrange(4) for _ in range(rng.randrange(0, 10))]
        base = once(numbers)
        want = once(min(reading(base, 0), reading(base, 1), key=len)) if base else []
        assert paths.pair_dedup(numbers) == want


def test_anchor_chain_by_trying_all(spark):
    rng = random.Random(5)
    for _ in range(40):
        edges = [(a, b, rng.randrange(1, 9)) for a, b in itertools.permutations(range(7), 2) if rng.random() < 0.5]
        kit = path_repair.Repair(graph.RoadGraph(edges), path_repair.RepairConfig(skip_penalty=rng.choice([1.0, 20.0, 50.0])))
        nodes = [rng.randrange(7) for _ in range(5)]
        direct = kit.cost(0, 6)
        candidates = kit.candidates(0, 6, nodes)
        want = [(i, v) for i, v in enumerate(nodes) if v not in (0, 6) and direct and None not in (kit.cost(0, v), kit.cost(v, 6)) and kit.cost(0, v) + kit.cost(v, 6) <= 2 * direct]
        assert candidates == want
        if not candidates:
            continue
        unit = max(direct, 1.0) / 100

        def price(chain):
            stops = [0, *(candidates[i][1] for i in chain), 6]
            legs = [kit.cost(a, b) for a, b in zip(stops, stops[1:], strict=False)]
            if None in legs or any(a == b for a, b in zip(stops[1:-1], stops[2:-1], strict=False)):
                return float("inf")
            return sum(legs) / unit + (len(candidates) - len(chain)) * kit.config.skip_penalty

        chains = [c for n in range(1, len(candidates) + 1) for c in itertools.combinations(range(len(candidates)), n)]
        least = min(price(c) for c in chains)
        got = kit.anchors(0, 6, candidates)
        assert any([candidates[i][1] for i in c] == got and abs(price(c) - least) < 1e-6 for c in chains)


def test_report_has_all_of_a_repair(spark):
    edges = [("A", "B", 10), ("B", "C", 10), ("C", "D", 10), ("D", "E", 10), ("B", "X", 15), ("X", "D", 15), ("B", "Y", 30), ("Y", "D", 2), ("E", "A", 5)]
    e = spark.createDataFrame(edges, "src string, dst string, miles bigint")
    records = spark.createDataFrame([(1, "A", "E", list("BCD")), (2, "A", "E", list("BXD")), (3, "E", "B", ["A"]), (4, "A", "Q", ["B"]), (5, "A", "E", [])], "id int, enid string, exid string, path array<string>")
    nodes = spark.createDataFrame([(u, float(i), 1.0) for i, u in enumerate("ABCE")], "unit string, lon double, lat double")
    units = spark.createDataFrame([(u, 1000 if u != "X" else 9000, 1, 1, 1, False) for u in "ABCDEXY"], "unit string, length bigint, roadtype int, feektype int, feehtype int, is_control boolean")
    rates = spark.createDataFrame([(1, 1, 2, 1.0)], "roadtype int, feetype int, vehicle_type int, feebykm double")
    rows = {r.id: r for r in path_repair.repair_report(records, e, "id", nodes, ["C"], units, rates, 2).collect()}
    assert len(rows) == 5
    one = rows[1]
    assert one.path == list("ABCDE") and one.result == list("BCD") and one.passes_works and one.missing == ["D"]
    assert [(p.seq, p.unit, p.lon) for p in one.points] == [(1, "A", 0.0), (2, "B", 1.0), (3, "C", 2.0), (4, "D", None), (5, "E", 3.0)]
    assert one.detour_path == list("ABXDE") and one.cheapest_path == list("ABYDE") and one.detour_miles == 50
    assert not rows[2].passes_works and rows[2].detour_path is None and rows[2].direct_passes_works
    assert rows[3].path == ["E", "A", "B"] and not rows[3].passes_works
    assert rows[4].status == "FAILED_NO_PATH" and rows[4].points == [] and rows[5].status == "FAILED_EMPTY_PATH"


def test_batch_of_repairs(spark):
    e = spark.createDataFrame([("A", "B", 10), ("B", "C", 10), ("C", "D", 10)], "src string, dst string, miles bigint")
    records = spark.createDataFrame([(1, "A", "D", list("BC")), (2, "A", "D", []), (3, "D", "A", ["B"]), (4, "A", "D", None), (5, None, "D", ["B"])], "id int, enid string, exid string, path array<string>")
    done, figures = path_repair.repair_batch(records, e, "id")
    assert {r.id: (r.status, r.errors) for r in done.collect() if r.id != 1} == {2: ("FAILED_EMPTY_PATH", []), 3: ("FAILED_NO_PATH", []), 4: ("FAILED_EMPTY_PATH", []), 5: ("FAILED_NO_PATH", [])}
    row = figures.first()
    assert (row.total, row.high_confidence, row.failed, row.valid, row.invalid) == (5, 1, 4, 5, 0)


def test_rejected_records(spark):
    e = spark.createDataFrame([("A", "B", 1), ("C", "D", 1)], "src string, dst string, miles int")
    rows = [(1, list("ABC")), (2, list("ACD")), (3, list("AB"))]
    df = spark.createDataFrame(rows, "id int, path array<string>").withColumns({"times": F.lit(None).cast("array<timestamp_ntz>"), "enid": F.lit(None).cast("string"), "exid": F.lit(None).cast("string"), "entime": F.lit(None).cast("timestamp_ntz"), "extime": F.lit(None).cast("timestamp_ntz")})
    assert [(r.id, r.error) for r in repair.rejected(repair.repair_intervals(df, e, "id")).collect()] == [(2, "no_way:A>C")]
