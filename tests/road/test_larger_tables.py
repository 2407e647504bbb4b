"""What queries do with many rows: equal paths once, nothing shuffled but what the next step needs."""

import random
from collections import Counter

from pyspark.sql import functions as F

from roadweave.operators import anchors, graph, impact, path_repair, repair, sheets
from roadweave.plans import more_queries, sheet_queries  # noqa: F401  their queries join those of queries
from roadweave.plans.queries import QUERIES

ROADS = [(i, (i + 1) % 12, 1) for i in range(12)] + [(i, (i + 5) % 12, 2) for i in range(12)]


def _shuffled(spark, run):
    """What run() returns, and the rows that Spark shuffled for it."""
    sc = spark.sparkContext
    store, no = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)

    def rows():
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, no, sc._jvm.java.util.ArrayList())
        return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = rows()
    out = run()
    return out, sum(n for k, n in rows().items() if k not in before)


def _anchor_tables(spark, copies):
    rng = random.Random(5)
    paths = [[rng.randrange(12) for _ in range(rng.randint(2, 7))] for _ in range(60)]
    rows = [(k * 100 + i, p[0], p[-1], p, 1 + i % 3) for k in range(copies) for i, p in enumerate(paths)]
    works = [(1, 3), (1, 4), (1, 5), (2, 8), (2, 9)]
    return rows, works, spark.createDataFrame(rows, "record_id bigint, enid bigint, exid bigint, path array<bigint>, flow bigint"), spark.createDataFrame(ROADS, "src bigint, dst bigint, miles bigint"), spark.createDataFrame(works, "works_id bigint, unit bigint")


def _in_order(path, a, b):
    return a in path and b in path and path.index(a) < len(path) - 1 - path[::-1].index(b)


def test_anchor_stats_by_brute_force_with_few_rows_shuffled(spark):
    rows, _, records, *_ = _anchor_tables(spark, 40)
    windows = [(w, s, e, level, c, a, b) for w, s, e, c in ((1, 3, 5, [3, 4, 5]), (1, 3, 4, [3, 4]), (2, 8, 9, [8, 9])) for level, (a, b) in enumerate([(2, 6), (1, 7), (0, 10), (11, 0)])]
    candidates = spark.createDataFrame(windows, "works_id bigint, start_unit bigint, end_unit bigint, level int, covered array<bigint>, anchor_start bigint, anchor_end bigint")
    found, moved = _shuffled(spark, lambda: {tuple(r)[:6]: tuple(r)[6:] for r in anchors.anchor_stats(candidates, records).collect()})
    expected = {}
    for w, s, e, level, c, a, b in windows:
        met = [(bool(set(p) & set(c)), x, y, f) for _, x, y, p, f in rows if _in_order(p, a, b)]
        if met:
            expected[w, s, e, level, a, b] = (*(sum(m[3] for m in met if m[0] == k) for k in (True, False)), *(sum(m[0] == k for m in met) for k in (True, False)), len({m[1:3] for m in met}))
    assert found == expected and len(found) > 6
    assert moved < len(rows) / 2, moved


def test_paths_are_assigned_once_each(spark):
    rows, works, records, roads, sites = _anchor_tables(spark, 40)
    (_, assigned), moved = _shuffled(spark, lambda: anchors.aggregate(records, sites, roads))
    got, last = _shuffled(spark, assigned.collect)
    assert len(got) == len(rows) and len({r.record_id for r in got}) == len(rows)
    touched = {w: {u for v, u in works if v == w} for w in (1, 2)}
    of = {}
    for r in got:
        path = rows[[x[0] for x in rows[:60]].index(r.record_id % 100)][3]
        assert of.setdefault(tuple(path), tuple(r)[4:]) == tuple(r)[4:]
        if r.works_id:
            assert _in_order(path, r.anchor_start, r.anchor_end) and r.route_type == ("pass" if touched[r.works_id] & set(path) else "bypass")
        else:
            assert r.route_type == "unassigned"
    assert {"pass", "bypass", "unassigned"} <= {r.route_type for r in got}
    assert moved + last < 4 * len(rows), (moved, last)


def test_searches_are_shared_by_records():
    calls = Counter()

    class Counted(graph.RoadGraph):
        def k_shortest(self, *a):
            calls["ways"] += 1
            return super().k_shortest(*a)

        def distances_to(self, *a):
            calls["rest"] += 1
            return super().distances_to(*a)

    kit = path_repair.Repair(Counted(ROADS))
    first = kit.run(0, 6, [0, 5, 10, 3, 6])
    once = dict(calls)
    assert kit.run(0, 6, [0, 5, 10, 3, 6]) == first and first["method"] == "anchors" and dict(calls) == once


def test_repairs_are_dealt_to_all_tasks(spark):
    roads = spark.createDataFrame(ROADS, "src bigint, dst bigint, miles bigint")
    records = spark.range(200).selectExpr("id", "id % 12 as enid", "(id + 5) % 12 as exid", "array(id % 12, (id + 3) % 12, (id + 5) % 12) as path").coalesce(1)
    assert path_repair.repair_paths(records, roads, "id").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_equal_records_of_a_batch_are_repaired_once(spark):
    roads = spark.createDataFrame(ROADS, "src bigint, dst bigint, miles bigint")
    rows = [(i, *((None, 4, [1, 2]), (0, 6, [0, 5, 10, 6]), (0, 6, None), (3, 3, [3, None, 3]))[i % 4]) for i in range(400)]
    records = spark.createDataFrame(rows, "id bigint, enid bigint, exid bigint, path array<bigint>")
    done, figures = path_repair.repair_batch(records, roads, "id")
    got = {r.id: tuple(r)[1:] for r in done.collect()}
    assert len(got) == 400 == figures.first().total and all(got[i] == got[i % 4] for i in got) and len({str(got[i]) for i in range(4)}) > 2
    alone = {r.id: tuple(r)[1:] for r in path_repair.repair_batch(records.where("id < 4"), roads, "id")[0].collect()}
    assert alone == {i: got[i] for i in range(4)}


def test_plans_share_searches(spark):
    roads = spark.createDataFrame([(f"U{a}", f"U{b}", m) for a, b, m in ROADS], "src string, dst string, miles bigint")
    assert repair.HELD >= 4096 and "lru_cache" in repair.repair_intervals.__globals__
    rows = [(i, [f"U{i % 12}", f"U{(i + 3) % 12}", f"U{(i + 7) % 12}"]) for i in range(48)]
    records = spark.createDataFrame(rows, "id bigint, path array<string>").selectExpr("*", "cast(null as array<timestamp_ntz>) as times", "'' as enid", "'' as exid", "cast(null as timestamp_ntz) as entime", "cast(null as timestamp_ntz) as extime")
    g = graph.RoadGraph([(f"U{a}", f"U{b}", m) for a, b, m in ROADS])
    assert {r.id: r.path for r in repair.repair_intervals(records, roads, "id").collect()} == {i: [u[0] for u in repair.planned(p, None, g).units] for i, p in rows}


def test_corners_do_not_make_the_path_again_for_each_element(spark):
    """An array that a lambda looks up is made anew for every element."""
    for name in ("r12_uturn", "dq12_backtrack_regions"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("stops") < 60, (name, plan.count("stops"))


def test_sheets_shuffle_numbers_and_not_ways(spark):
    gate = lambda n, way: f"G0005600000{n:03d}{way}"
    roads = spark.createDataFrame([(gate(a, 10), gate(b, 10), m) for a, b, m in ROADS], "src string, dst string, miles bigint")
    rng = random.Random(3)
    rows = [(i, "|".join(gate(rng.randrange(12), rng.choice((10, 20))) for _ in range(6))) for i in range(300)]
    valid = spark.createDataFrame([(gate(n, 10),) for n in range(12)], "unit string")
    found = lambda: sheets.checked_sheet(spark.createDataFrame(rows, "id bigint, units string"), "id", "units", roads, valid).collect()
    got, moved = _shuffled(spark, found)
    assert len(got) == 300 and moved < 25_000, moved


def test_anchor_flow_joins_paths_before_types(spark):
    n = 300
    trips = spark.createDataFrame([(1, i % 7 + 9, [1, 3, i % 5 + 4, i % 7 + 9], v, i) for i in range(n) for v in range(1, 6)], "enid int, exid int, path array<int>, vehicle_type int, i int")
    trips = trips.withColumn("times", F.transform("path", lambda _, k: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("i"), hours=k))).drop("i")
    works = spark.sql("select 1 as works_id, array(3, 4) as units, date '2024-01-03' as start, date '2024-01-20' as end")
    got, moved = _shuffled(spark, lambda: impact.anchor_flow(trips, works).collect())
    assert sum(r.con_flow for r in got) == 18 * 5 and sum(r.sp_flow for r in got) == 0 and {r.vehicle_type for r in got} == set(range(1, 6))
    assert moved < 5 * n, moved
