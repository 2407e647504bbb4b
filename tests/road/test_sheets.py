import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadweave.operators import graph, path_report, sheets


def _turn(u):
    return u[:-2] + {"10": "20", "20": "10"}[u[-2:]] if u and u[-2:] in ("10", "20") else None


def _toll_graph(seed, n=7, extra=6):
    rng = np.random.default_rng(seed)
    ahead = {(i, i + 1): int(rng.integers(1, 5)) for i in range(n - 1)} | {(int(a), int(b)): int(rng.integers(1, 9)) for a, b in rng.integers(0, n, (extra, 2)) if a != b}
    name = lambda i, way: f"G0005610010{i:03d}{way}"
    return [(name(a, 10), name(b, 10), m) for (a, b), m in ahead.items()] + [(name(b, 20), name(a, 20), m) for (a, b), m in ahead.items()]


def _unit_counts(edges):
    """By Floyd and Warshall: units on the path of the fewest miles, then the fewest units."""
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    best = {(a, a): (0, 1) for a in nodes}
    for a, b, m in edges:
        best[a, b] = min(best.get((a, b), (10**9, 0)), (m, 2))
    for k, a, b in itertools.product(nodes, nodes, nodes):
        if (a, k) in best and (k, b) in best:
            best[a, b] = min(best.get((a, b), (10**9, 0)), (best[a, k][0] + best[k, b][0], best[a, k][1] + best[k, b][1] - 1))
    return {k: v[1] for k, v in best.items()}


def _greedy(counts, start, units, most=100):
    """The rule as a list of eight ways, in rising order of who wins when equal."""
    n = lambda a, b: counts.get((a, b), 1 if a == b and a is not None else most) if a and b else most
    place, left, out = start, list(dict.fromkeys(u for u in units if u != start)), []
    while left:
        found = []
        for i, u in enumerate(left):
            v, opposite = _turn(u), _turn(place)
            ways = [(n(u, place), u, "back"), (n(v, place), v, "back"), (n(u, opposite), u, "back"), (n(v, opposite), v, "back"), (n(place, v), v, "ahead"), (n(opposite, v), v, "ahead"), (n(place, u), u, "ahead"), (n(opposite, u), u, "ahead")]
            best = ways[0]
            for w in ways[1:]:
                if w[1] and w[0] <= best[0]:
                    best = w
            found.append((*best, i, u))
            if best[0] <= 2:
                break
        best = min(found, key=lambda f: (f[0], f[3])) if found[-1][0] > 2 else found[-1]
        if best[0] >= most:
            return out + [(u, u, "lost") for u in left]
        out.append((best[4], best[1], best[2]))
        left.pop(best[3])
        if best[2] == "ahead":
            place = best[1]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_order_by_the_rule(spark, seed):
    edges = _toll_graph(seed)
    counts, rng = _unit_counts(edges), np.random.default_rng(seed)
    names = sorted({a for a, _, _ in edges} | {b for _, b, _ in edges}) + ["G000561001009910", "S00056100100"]
    rows = [(i, [names[int(rng.integers(0, len(names)))]], [names[int(j)] for j in rng.integers(0, len(names), int(rng.integers(0, 7)))]) for i in range(60)]
    rows += [(100, [], names[:3]), (101, None, names[:2]), (102, names[:2], None), (103, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "key int, starts array<string>, units array<string>")
    found = {r.key: [tuple(o) for o in r.ordered] for r in sheets.greedy_order(df, spark.createDataFrame(edges, "src string, dst string, miles int")).collect()}
    assert len(found) == len(rows)
    for key, starts, units in rows[:60]:
        assert found[key] == _greedy(counts, starts[0], units)
    assert found[100] == [(u, u, "lost") for u in names[:3]] and len(found[101]) == 2 and found[102] == [] and found[103] == found[0]


def _checked(text, counts, valid, typos):
    """The rules one after the other."""
    for a, b in typos.items():
        text = text.replace(a, b)
    ids = [x.strip() for x in text.replace(",", "|").replace("\n", "|").replace("\t", "|").split("|") if x.strip()]
    gates, stations = [u for u in ids if len(u) == 16], [u for u in ids if len(u) == 14]
    turned, lost, outside, ordered = [], [], [], gates
    n = lambda a, b: counts.get((a, b)) if a != b else None
    if len(gates) > 1:
        a, b = gates[0], gates[-1]
        ways = [(n(s, t), i, s, t) for i, (s, t) in enumerate(((a, b), (a, _turn(b) or b), (_turn(a) or a, b), (_turn(a) or a, _turn(b) or b))) if n(s, t)]
        if not ways:
            lost = gates
        else:
            _, _, s, t = min(ways)
            turned = [(a, s)] * (a != s) + [(b, t)] * (b != t)
            at = []
            for i, u in enumerate(gates):
                place, as_ = (1 if u == s else n(s, u)), u
                if place is None and _turn(u) and n(s, _turn(u)):
                    place, as_ = n(s, _turn(u)), _turn(u)
                    turned.append((u, as_))
                if place is None:
                    lost.append(u)
                at.append((place or 1 << 30, i, as_))
            ordered = [x[2] for x in sorted(at)]
        for u in gates[1:-1]:
            if not any(n(x, y) or x == y for f in (u, _turn(u)) if f for e in (a, b) for x, y in ((e, f), (f, e))):
                outside.append(u)
    after = ",".join(x for x in ("|".join(ordered), "|".join(stations)) if x) if text.strip() else text
    return text, after, [u for u in ids if len(u) not in (14, 16)], [u for u in ids if u not in valid], turned, lost, outside


def test_sheet_rule_by_rule(spark):
    edges = _toll_graph(5) + [("G000561001008010", "G000561001008110", 1)]
    counts, rng = _unit_counts(edges), np.random.default_rng(5)
    names = sorted({a for a, _, _ in edges} | {b for _, b, _ in edges})
    valid = set(names[::2]) | {"S0005610010001"}
    make = lambda: [names[int(i)] for i in rng.integers(0, len(names), int(rng.integers(0, 6)))] + ["S0005610010001", "S0005610010002", "X1"][: int(rng.integers(0, 4))]
    texts = [str(rng.choice(["|", ",", "\n", " | "])).join(make()) for _ in range(80)] + ["", "  ", names[0].replace("G00056", "G0OO56"), "|".join([names[0], "G000561001009999", names[3]])]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, None), (501, texts[0])]
    typos = {"G0OO56": "G00056"}
    df, e = spark.createDataFrame(rows, "id int, f string"), spark.createDataFrame(edges, "src string, dst string, miles int")
    found = {r.id: r for r in sheets.checked_sheet(df, "id", "f", e, spark.createDataFrame([(v,) for v in valid], "unit string"), typos).collect()}
    assert len(found) == len(rows) and found[500].after is None and not found[500].changed
    for i, t in rows:
        if t is not None:
            r = found[i]
            assert (r.corrected, r.after, r.unknown, r.invalid, [(x.old, x.new) for x in r.turned], r.lost, r.outside) == _checked(t, counts, valid, typos)
            assert r.changed == (r.before != r.after)


def test_sections_inside_and_labels(spark):
    rows = spark.createDataFrame([(1, "R", sheets.BOTH_WAYS, [1, 2, 3, 3]), (2, "R", "east", [1, 2]), (3, "Q", "east", [1]), (4, "R", "east", None)], "id int, road string, direction string, units array<int>")
    sections = spark.createDataFrame([("R", "a", sheets.COUNTED_WAY, 2, [1, 3]), ("R", "b", sheets.COUNTED_WAY, 1, [2]), ("R", "b", sheets.COUNTED_WAY, 3, [1]), ("R", "c", sheets.COUNTED_WAY, 0, [3, 4]), ("R", "d", "east", 0, [2, 2])], "road string, section string, direction string, nth int, units array<int>")
    inside = sheets.sections_inside(rows, sections, "id")
    assert {r.id: r.sections for r in inside.collect()} == {1: ["b", "a"], 2: ["d"]}
    plan = inside._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    plans = spark.createDataFrame([(1, "R", "x", 0), (2, "R", "x", 0), (3, "Q", "x", 0)], "id int, road string, scheme string, situation int")
    works = lambda *t: spark.createDataFrame([("R", "x", 0, s, k) for s, k in t], "road string, scheme string, situation int, section string, type_name string")
    label = lambda *t: {r.id: r.label for r in sheets.plan_labels(plans, inside, works(*t), "id").collect()}
    assert label(("a", "full"), ("b", "lane"), ("d", "full")) == {1: "b：lane，a：full", 2: "full", 3: sheets.OPEN_TO_ALL}
    assert label(("a", "full"), ("b", sheets.OPEN_TO_ALL)) == {1: "full", 2: sheets.OPEN_TO_ALL, 3: sheets.OPEN_TO_ALL}
    months = sheets.rows_of_plans(spark.createDataFrame([(1, "R", "2027-01")], "id int, road string, month string"), spark.createDataFrame([("R", "2028-01", "p"), ("R", "2028-02", "q")], "road string, month string, plan string"), ["road"])
    assert [(r.id, r.month_of_row, r.month, r.plan) for r in months.collect()] == [(1, "2027-01", "2028-01", "p")]


def _regions(points, least=150):
    if len(points) < 3:
        return []
    out, start = [], None
    for i in range(len(points) - 2):
        three = points[i : i + 3]
        if any(p is None or None in p for p in three):
            continue
        (ax, ay), (bx, by), (cx, cy) = three
        a, b = math.hypot(ax - bx, ay - by), math.hypot(cx - bx, cy - by)
        angle = math.degrees(math.acos(max(-1, min(1, ((ax - bx) * (cx - bx) + (ay - by) * (cy - by)) / (a * b))))) if a and b else 0
        if angle >= least:
            start = i if start is None else start
        elif start is not None:
            out.append((start, i + 2))
            start = None
    return out + ([(start, len(points) - 1)] if start is not None else [])


def test_backtrack_regions_by_a_loop(spark):
    rng = np.random.default_rng(0)
    paths = [[None if rng.random() < 0.12 else (float(x), None if rng.random() < 0.05 else float(y)) for x, y in rng.integers(0, 4, (n, 2))] for n in list(range(6)) * 12 + [30, 40]]
    paths.append([(float(i), 0.0) for i in range(9)])
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "id int, points array<struct<lon:double,lat:double>>")
    found = df.select("id", path_report.backtrack_regions(F.col("points")).alias("r"))
    assert "Exchange" not in found._jdf.queryExecution().toString()
    for r in found.collect():
        assert [tuple(x) for x in r.r] == _regions(paths[r.id])


def test_unit_classes(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 9, 3]), ([1], []), ([], [1])], "a array<int>, b array<int>")
    assert [tuple(r.c) for r in df.select(path_report.unit_classes(F.col("a"), F.col("b")).alias("c")).collect()] == [([0, 2], [1], [1], 0, 2), ([], [], [0], None, None), ([], [0], [], 0, 0)]


def test_trees_are_kept(spark):
    roads, held = graph.RoadGraph([("a10", "b10", 1), ("b10", "c10", 1)]), {}
    assert sheets.nearest_next(roads, ["a10"], ["c10", "b10"], _turn, held=held) == [("b10", "b10", "ahead"), ("c10", "c10", "ahead")]
    assert ("ahead", "a10") in held
