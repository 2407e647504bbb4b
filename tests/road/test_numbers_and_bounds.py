import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadweave.operators import graph, numbering


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_numbers_of_a_whole_table(spark, ranges):
    rng = np.random.default_rng(1)
    rows = [(i, int(k)) for i, k in enumerate(rng.integers(0, 6, 500))] + [(1000, None), (1001, None), (7, 3), (7, 3)]
    df = spark.createDataFrame(rows, "id int, k int")
    found = numbering.numbered(df, [F.desc("k")], "n", ranges)
    got = found.orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(rows) + 1))
    assert sorted((r.id, -1 if r.k is None else r.k) for r in got) == sorted((i, -1 if k is None else k) for i, k in rows)
    keys = [-1 if r.k is None else r.k for r in got]
    assert keys == sorted(keys, reverse=True)
    assert "SinglePartition" not in _plan(found)
    assert numbering.numbered(df.limit(0), ["id"]).count() == 0


def test_one_value_of_many_rows_is_spread_over_ranges(spark):
    df = spark.range(20_000).withColumn("k", F.lit(1))
    parts = numbering._in_ranges(df, ["k"], [], 8)
    sizes = [r["count"] for r in parts.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000


@pytest.mark.parametrize("ranges", [1, 4])
def test_sums_from_the_first_row(spark, ranges):
    rng = np.random.default_rng(2)
    rows = [(i, int(v), -int(v)) for i, v in enumerate(rng.integers(-50, 50, 300))] + [(300, None, 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame([tuple(None if x is None else int(x) for x in r) for r in rows], "id int, v int, w int")
    found = {r.id: (r.a, r.b, r.v) for r in numbering.running_sums(df, ["id"], {"a": "v", "b": "w"}, ranges).collect()}
    a = b = 0
    for i, v, w in sorted(rows, key=lambda r: r[0]):
        a, b = a + (0 if v is None else v), b + w
        assert found[i] == (a, b, v)
    assert numbering.running_sums(df.limit(0), ["id"], {"a": "v"}).count() == 0


def _random_graph(seed, n=9, edges=26):
    rng = np.random.default_rng(seed)
    return sorted({(int(a), int(b)): int(m) for a, b, m in zip(rng.integers(0, n, edges), rng.integers(0, n, edges), rng.integers(1, 9, edges), strict=True)}.items())


def _all_simple(edges, source, target, depth):
    step = {}
    for (a, b), m in edges:
        if a != b:
            step.setdefault(a, []).append((b, m))
    found, stack = [], [((source,), 0)]
    while stack:
        path, miles = stack.pop()
        if path[-1] == target:
            found.append((miles, path))
        elif len(path) <= depth:
            stack += [((*path, b), miles + m) for b, m in step.get(path[-1], ()) if b not in path]
    return sorted(found, key=lambda x: (x[0], len(x[1]), x[1]))


@pytest.mark.parametrize("depth, most, factor", [(8, None, 2.0), (4, 3, 1.5)])
def test_bounded_paths_by_enumeration(spark, depth, most, factor):
    raw = _random_graph(depth)
    edges = spark.createDataFrame([(a, b, m) for (a, b), m in raw], "src int, dst int, miles bigint")
    pairs = list(itertools.product(range(9), range(9))) + [(0, 99), (None, 1), (0, 1)]
    df = spark.createDataFrame(pairs, "source int, target int")
    found = {}
    for r in graph.bounded_search(df, edges, factor, depth, most).collect():
        found.setdefault((r.source, r.target), []).append((r.path_no, r.miles, tuple(r.path)))
    for s, t in itertools.product(range(9), range(9)):
        want = _all_simple(raw, s, t, depth) if s != t else []
        want = [x for x in want if x[0] <= factor * want[0][0]][:most]
        assert sorted(found.get((s, t), [])) == [(i + 1, *x) for i, x in enumerate(want)]
    assert not {k for k in found if 99 in k or None in k}


def test_partial_paths_without_an_end_in_reach_go_at_once(spark):
    # 0-1-2-3 is the way; from each place a long detour leads on, and a dead end hangs on 1
    raw = [(0, 1, 1), (1, 2, 1), (2, 3, 1), (0, 4, 50), (4, 3, 1), (1, 5, 1), (5, 6, 1), (6, 7, 1), (1, 8, 1), (8, 2, 2), (3, 9, 1)]
    edges = spark.createDataFrame(raw, "src int, dst int, miles bigint")
    pair = spark.createDataFrame([(0, 3)], "source int, target int")
    levels = [sorted(tuple(r.path) for r in x.collect()) for x in graph.bounded_levels(pair, edges, 2.0, 30)]
    assert levels == [[(0, 1)], [(0, 1, 2), (0, 1, 8)], [(0, 1, 2, 3), (0, 1, 8, 2)], [(0, 1, 8, 2, 3)]]
    nothing = spark.createDataFrame([(3, 0), (0, 0)], "source int, target int")
    assert graph.bounded_search(nothing, edges).count() == 0


def test_best_paths_in_order_and_without_opening_loops():
    for seed in range(12):
        raw = _random_graph(seed)
        roads = graph.RoadGraph([(a, b, m) for (a, b), m in raw])
        for s, t in itertools.permutations(range(6), 2):
            assert [(c, p) for c, p in roads.k_shortest(s, t, 6)] == _all_simple(raw, s, t, 9)[:6]
    # a dense net with cheap steps everywhere, whose only way out has to be taken before they are used up
    n, entry, out = 24, 100, 200
    net = [(a, b, 1) for a in range(n) for b in range(n) if a != b] + [(entry, 0, 1), (0, out, 500)]
    roads = graph.RoadGraph(net)
    assert roads.k_shortest(entry, out, 5) == [(501, (entry, 0, out))]
