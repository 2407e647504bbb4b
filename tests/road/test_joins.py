import numpy as np
import pytest
from pyspark.sql import functions as F

from roadweave.operators import joins


@pytest.mark.parametrize("ranges", [1, 5, 40])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_last_row_not_after(spark, ranges, keys):
    rng = np.random.default_rng(ranges)
    left = [(i, None if rng.random() < 0.1 else str(rng.choice(["a", "a", "a", "b", "c"])), None if rng.random() < 0.1 else int(rng.integers(0, 40))) for i in range(200)]
    right = [(None if rng.random() < 0.1 else str(rng.choice(["a", "b", "d"])), None if rng.random() < 0.1 else int(rng.integers(5, 40)), int(rng.integers(0, 9))) for _ in range(30)]
    l, r = spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, t int, v int")
    found = joins.asof_join(l, r if keys else r.drop("k"), "t", keys, "v", ranges)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    got = {x.id: x.v for x in found.collect()}
    assert len(got) == len(left)
    for i, k, t in left:
        fits = [(at, v) for rk, at, v in right if at is not None and t is not None and at <= t and (not keys or rk == k)]
        assert got[i] == (max(fits)[1] if fits else None)
    assert joins.asof_join(l, r.limit(0), "t", ("k",), "v").where("v is not null").count() == 0


def test_bands_by_all_pairs(spark):
    rng = np.random.default_rng(0)
    ends = lambda: sorted(float(x) for x in rng.integers(0, 100, 2))
    rules = [(i, *ends(), *ends(), int(rng.integers(0, 3))) for i in range(1500)] + [(2000, 0.0, 1e300, 0.0, float("inf"), 1), (2001, None, 5.0, 0.0, 9.0, 1), (2002, 5.0, 5.0, 0.0, 9.0, 1)]
    rows = [(i, None if rng.random() < 0.05 else float(rng.integers(-5, 105)), float(rng.integers(-5, 105)), int(rng.integers(0, 3))) for i in range(60)] + [(100 + i, 7.0, 7.0, 1) for i in range(60)]
    left, right = spark.createDataFrame(rows, "id int, a double, b double, kind int"), spark.createDataFrame(rules, "rule int, x_min double, x_max double, y_min double, y_max double, rule_kind int")
    found = joins.band_join(left, right, "a", "b", F.col("kind") == F.col("rule_kind"))
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {(i, r) for i, a, b, k in rows for r, x1, x2, y1, y2, rk in rules if None not in (a, x1) and x1 <= a < x2 and y1 <= b < y2 and k == rk}
    want |= {(i, None) for i, *_ in rows if i not in {x[0] for x in want}}
    got = [(r.id, r.rule) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert joins.band_join(left, right.limit(0), "a", "b").count() == len(rows)
