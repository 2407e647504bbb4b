"""Path, graph and repair kernels against worked examples and plain versions."""

import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from roadweave.functions import measures, paths
from roadweave.operators import anchors, graph, path_repair, repair


def test_pair_dedup():
    assert paths.pair_dedup([]) == []
    assert paths.pair_dedup([5, 5, 3]) == [5, 3]
    assert paths.pair_dedup([1, 2, 1, 2, 3]) == [1, 2, 3]
    assert paths.pair_dedup([1, 2, 3, 4]) == [1, 2, 3, 4]
    assert paths.pair_dedup([9, 1, 2, 1, 2]) == [9, 1, 2]


def test_path_expressions(spark):
    df = spark.createDataFrame([("A| B ||C",), (None,), ("",)], "p string")
    assert [r[0] for r in df.select(paths.split_path(F.col("p"))).collect()] == [["A", "B", "C"], None, []]
    p = spark.createDataFrame([(["A", "A", "B", "A", "C"],)], "p array<string>")
    row = p.select(
        paths.adjacent_dedup(F.col("p")), paths.visits_in_order(F.col("p"), F.lit("B"), F.lit("A")), paths.visits_in_order(F.col("p"), F.lit("C"), F.lit("B")),
        paths.flow_anchor(F.col("p"), F.array(F.lit("C"), F.lit("B"))), paths.reversed_unit(F.lit("G007061003000220")), paths.reversed_unit(F.lit("X30")),
    ).first()
    assert list(row) == [["A", "B", "A", "C"], True, False, "C", "G007061003000210", None]


def at(clock):
    return datetime.strptime(f"2026-03-15 {clock}", "%Y-%m-%d %H:%M:%S")


def _repaired(spark, units, times, roads, enid=None, exid=None):
    edges = spark.createDataFrame([(*x.split(">"), 1) for x in roads.split()], "src string, dst string, miles int")
    row = spark.createDataFrame([(1, units, times, enid, exid, None, None)], "id int, path array<string>, times array<timestamp_ntz>, enid string, exid string, entime timestamp_ntz, extime timestamp_ntz")
    return repair.repair_intervals(row, edges, "id").first()


def test_interval_repair_examples(spark):
    times = [at("10:00:00"), at("10:10:00"), at("10:20:00")]
    intact = _repaired(spark, list("ABC"), times, "A>B B>C")
    assert intact.path == list("ABC") and intact.times == times and not intact.changes
    filled = _repaired(spark, list("ABC"), [at("10:00:00"), at("10:20:00"), at("10:30:00")], "A>X X>B B>C")
    assert filled.path == list("AXBC") and filled.times[1:3] == [at("10:06:40"), at("10:13:20")]
    turned = _repaired(spark, ["A", "G007061003000220", "C"], times, "A>G007061003000210 G007061003000210>C")
    assert turned.path == ["A", "G007061003000210", "C"] and turned.times == times and turned.changes[0].reason == "reverse_fix"
    again = _repaired(spark, list("ABCA"), [*times, at("10:30:00")], "A>B B>C C>A")
    assert again.path == list("ABC") and again.times[0] == at("10:00:00")
    broken = _repaired(spark, list("ABC"), None, "B>C Q>A")
    assert broken.error == "no_way:A>B" and broken.path == list("ABC") and broken.times == []
    station = _repaired(spark, list("BC"), None, "S>A A>B B>C C>T", "S", "T")
    assert station.path == list("ABC")


def test_graph_searches_match_enumeration():
    rng = random.Random(7)
    for _ in range(15):
        nodes = range(7)
        rows = [(a, b, rng.randrange(1, 6)) for a, b in itertools.permutations(nodes, 2) if rng.random() < 0.4]
        g = graph.RoadGraph(rows)

        def every(a, b, banned=frozenset()):
            out = []

            def walk(path, cost):
                if path[-1] == b:
                    out.append((cost, len(path), path))
                    return
                for to, miles in g.next.get(path[-1], {}).items():
                    if to not in path and to not in banned:
                        walk((*path, to), cost + miles)

            walk((a,), 0)
            return sorted(out)

        for a, b in itertools.permutations(nodes, 2):
            all_ = every(a, b)
            assert [x[0] for x in g.k_shortest(a, b, 4)] == [x[0] for x in all_[:4]]
            assert (g.shortest(a, b) or None) == ((all_[0][0], all_[0][2]) if all_ else None)
            if 3 not in (a, b):
                without = every(a, b, frozenset([3]))
                assert (g.shortest(a, b, frozenset([3])) or (None,))[0] == (without[0][0] if without else None)
            inner = [set(p[1:-1]) for _, p in g.disjoint(a, b, 3)]
            assert all(not x & y for x, y in itertools.combinations(inner, 2))


def test_reverse_penalty_opens_every_edge():
    g = graph.RoadGraph([("a", "b", 3)], reverse_penalty=1e9)
    assert g.shortest("b", "a") == (1e9, ("b", "a")) and graph.RoadGraph([("a", "b", 3)]).shortest("b", "a") is None


CHAIN = [(a, b, 1) for a, b in zip("ABCDEFGHIJK", "BCDEFGHIJKL", strict=True)] + [("X", "F", 1), ("Y", "H", 1), ("L", "Y", 1)]
RECORDS = [("r001", "A", "L", list("ABCDEFGHIJKL"), 100.0), ("r002", "A", "L", list("ABXFGHIJKL"), 50.0), ("r003", "X", "L", list("XUVL"), 20.0), ("r004", "A", "L", list("ABCDEZZFGHIJKL"), 30.0), ("r005", "B", "F", list("BCDEF"), 40.0)]


def test_anchor_aggregation_invariants(spark):
    edges = spark.createDataFrame(CHAIN, "src string, dst string, miles int")
    works = spark.createDataFrame([("w", u) for u in "CDEFGHIJK"], "works_id string, unit string")
    records = spark.createDataFrame(RECORDS, "record_id string, enid string, exid string, path array<string>, flow double")
    pairs, assigned = anchors.aggregate(records, works, edges)
    pairs, assigned = pairs.collect(), {r["record_id"]: r for r in assigned.collect()}
    assert set(assigned) == {r[0] for r in RECORDS}
    assert len({(r["works_id"], r["anchor_start"], r["anchor_end"]) for r in pairs}) == len(pairs)
    for record, _, _, path, _ in RECORDS:
        r = assigned[record]
        if r["route_type"] == "unassigned":
            assert r["anchor_start"] is None
        else:
            assert path.index(r["anchor_start"]) < len(path) - 1 - path[::-1].index(r["anchor_end"])
    assert assigned["r001"]["route_type"] == "pass" and assigned["r003"]["route_type"] == "bypass"  # X to L lies around the site


def test_components_and_portals(spark):
    edges = spark.createDataFrame([("A", "B", 1), ("B", "C", 1), ("M", "N", 1), ("Z", "A", 1), ("C", "Q", 1)], "src string, dst string, miles int")
    works = spark.createDataFrame([("w", u) for u in "ABCMN"], "works_id string, unit string")
    parts = graph.works_components(works, edges)
    assert {(r["unit"], r["component"]) for r in parts.collect()} == {("A", "A"), ("B", "A"), ("C", "A"), ("M", "M"), ("N", "M")}
    assert {(r["unit"], r["kind"]) for r in graph.portals(parts, edges).collect()} == {("A", "entry"), ("C", "exit")}


def test_path_repair():
    assert path_repair.common_subsequence("ABCBDAB", "BDCABA") == 4
    g = graph.RoadGraph([(a, b, 1000) for a, b in zip("ABCDE", "BCDEF", strict=True)] + [("A", "X", 900), ("X", "C", 5000)])
    r = path_repair.Repair(g)
    found = r.run("A", "F", ["A", "C", "E", "F"])
    assert found["path"] == list("ABCDEF") and found["method"] == "anchors" and found["detour_ratio"] == 1.0 and found["status"] is None
    assert r.run("A", "F", ["?"])["status"] == "FAILED_EMPTY_PATH" and r.run("F", "A", ["A"])["status"] == "FAILED_NO_PATH"
    assert r.tidied(list("ABABC")) == (list("ABAC"), 2) or r.tidied(list("ABABC"))[1] >= 1
    assert r.plain("A", "F", ["B", "?", "D"])[-1] == "F"


@pytest.mark.parametrize(("confidence", "status"), [(85.0, "HIGH_CONFIDENCE"), (65.0, "MEDIUM_CONFIDENCE"), (40.0, "LOW_CONFIDENCE"), (39.9, "NEED_MANUAL_REVIEW")])
def test_repair_status(spark, confidence, status):
    assert spark.range(1).select(measures.repair_status(F.lit(confidence))).first()[0] == status


def test_same_period_and_turns(spark):
    row = spark.range(1).select(measures.same_period(F.to_date(F.lit("2024-02-29"))).cast("string"), measures.angle_between(F.lit(350.0), F.lit(10.0)), F.round(measures.bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)), 6)).first()
    assert list(row) == ["2023-02-28", 20.0, 90.0]


def test_dates(spark):
    from roadweave.functions import dates

    day = F.to_date(F.lit("2026-03-15"))
    row = spark.sql("select '46096' as month_text").select(dates.week_range(day)[0].cast("string"), dates.month_list(day, F.to_date(F.lit("2026-05-01"))), dates.business_days(day, F.to_date(F.lit("2026-03-22"))), F.size(dates.batches(day, F.to_date(F.lit("2026-03-22")), 3)), dates.topology_version(day), dates.month_key(F.lit("2027/1/1")), dates.month_key(F.col("month_text"))).first()
    assert list(row) == ["2026-03-09", ["202603", "202604", "202605"], 5, 3, "202512", "2027-01", "2026-03"]
