import os
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadweave.operators import impact, numbering
from roadweave.sources import readers, sinks


def test_ids_stay_from_run_to_run(spark, tmp_path):
    path = f"file://{tmp_path}/ids"
    first = spark.createDataFrame([("b", 1), ("a", 2), ("a", 2), ("c", None)], "k string, v int")
    rows = lambda df: {(r.k, r.v): r.id for r in df.collect()}
    one = rows(numbering.keep_ids(path, first, ["k", "v"]))
    assert one == {("a", 2): 1, ("b", 1): 2, ("c", None): 3}
    assert rows(numbering.keep_ids(path, first, ["k", "v"])) == one
    two = rows(numbering.keep_ids(path, spark.createDataFrame([("a", 1), ("c", None), ("0", 9)], "k string, v int"), ["k", "v"]))
    assert two == one | {("0", 9): 4, ("a", 1): 5}
    edges = spark.createDataFrame([("a", "b"), ("b", "z")], "src string, dst string")
    ids = spark.createDataFrame([("a", 1), ("b", 2)], "node string, id bigint")
    assert {tuple(r) for r in numbering.with_ids(edges, ids, {"src": "s", "dst": "t"}, "node").collect()} == {("a", "b", 1, 2), ("b", "z", 2, None)}


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    path, keys = f"file://{tmp_path}/ledger", {"unit": "string"}
    batch = lambda *t: spark.createDataFrame(list(t), "unit string, n int")
    total = lambda: {r.unit: r.n for r in sinks.ledger_totals(spark, path, keys, ["n"]).collect()}
    sinks.add_batch(batch(("a", 1), ("a", 2), ("b", 5)), path, 0, list(keys), ["n"])
    sinks.add_batch(batch(("a", 10)), path, 1, list(keys), ["n"])
    sinks.add_batch(batch(("a", 10)), path, 1, list(keys), ["n"])
    assert total() == {"a": 13, "b": 5}
    assert sinks.fold_ledger(spark, path, keys, ["n"]) == 1
    sinks.add_batch(batch(("a", 10)), path, 1, list(keys), ["n"])  # again, after the fold
    sinks.add_batch(batch(("c", 7)), path, 2, list(keys), ["n"])
    assert total() == {"a": 13, "b": 5, "c": 7}
    assert sinks.fold_ledger(spark, path, keys, ["n"]) == 2 and total() == {"a": 13, "b": 5, "c": 7}


def test_a_stream_that_fails_and_starts_again(spark, tmp_path):
    source, path, mark = f"{tmp_path}/in", f"file://{tmp_path}/ledger", f"{tmp_path}/mark"
    put = lambda name, *t: spark.createDataFrame(list(t), "unit string, n int").coalesce(1).write.parquet(f"file://{source}/{name}")
    put("1", ("a", 1), ("b", 2))
    rows = lambda: spark.readStream.schema("unit string, n int").option("recursiveFileLookup", True).parquet(f"file://{source}")
    sinks.accumulate_stream(rows(), path, ["unit"], ["n"], mark).awaitTermination(120)
    put("2", ("a", 5))

    def fails(batch, no):
        sinks.add_batch(batch, path, no, ["unit"], ["n"])
        raise RuntimeError("after the batch was kept")

    broken = rows().writeStream.foreachBatch(fails).option("checkpointLocation", mark).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="after the batch was kept"):
        broken.awaitTermination(120)
    sinks.accumulate_stream(rows(), path, ["unit"], ["n"], mark).awaitTermination(120)
    assert {r.unit: r.n for r in sinks.ledger_totals(spark, path, {"unit": "string"}, ["n"]).collect()} == {"a": 6, "b": 2}


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_only_partitions_with_a_change_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(i, i % 3, None if i % 5 == 0 else i, "x") for i in range(30)]
    spark.createDataFrame(rows, "id int, part int, rank int, other string").repartition(1).write.partitionBy("part").parquet(f"file://{path}")
    before = _files(path)
    new = spark.createDataFrame([(1, 100), (4, None), (2, 2), (0, None), (5, None), (99, 1), (7, 1), (7, 2)], "id int, rank int")
    assert sinks.write_changes(spark, f"file://{path}", new, ["id"], ["rank"], ["part"]) == 2
    want = {i: (p, {1: 100, 4: None}.get(i, r), o) for i, p, r, o in rows}
    read = lambda: {r.id: (r.part, r["rank"], r.other) for r in spark.read.parquet(f"file://{path}").collect()}
    assert read() == want
    after = _files(path)
    kept = {f for f in before if "part=1" not in f}
    assert len(kept) >= 2 and all(after.get(f) == before[f] for f in kept) and not {f for f in after if "part=1" in f} & set(before)
    assert sinks.write_changes(spark, f"file://{path}", new, ["id"], ["rank"], ["part"]) == 0 and _files(path) == after


def test_files_of_a_month(spark, tmp_path):
    folder = tmp_path / "202602"
    folder.mkdir()
    columns = list(readers.TRIP_COLUMNS)
    for day in range(1, 29):
        if day in (5, 20):
            continue
        values = {c: f"{c[:4].upper()}{i}.{day}" for i, c in enumerate(columns)}
        if day % 3 == 0:  # by position, one row short
            text = ",".join(values[c] for c in columns) + "\nx1,e1\n"
        elif day % 3 == 1:  # by name, in another order, two columns missing
            names = columns[::-1][2:]
            text = ",".join(names) + "\n" + ",".join(values[c] for c in names) + "\n"
        else:
            text = ",".join(columns) + "\n" + ",".join(values[c] for c in columns) + "\nenid,in,data\n"
        (folder / f"data_202602{day:02d}.csv").write_text(text)
    (folder / "data_20260228.csv").write_text("")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("month", "month")
    found = readers.read_trip_csv(spark, f"file://{folder}")
    spark.sparkContext.setJobGroup("other", "other")
    assert len(jobs.getJobIdsForGroup("month")) <= 3  # headers, names and their shuffle, whatever the number of files
    assert str(found._jdf.queryExecution().optimizedPlan().toString()).count("Relation [") == 3
    got = found.collect()
    days = [d for d in range(1, 28) if d not in (5, 20)]
    want = sum({0: 2, 1: 1, 2: 2}[d % 3] for d in days)
    assert len(got) == want
    by = {r.enid: r for r in got}
    assert by["ENID1.4"].exid == "EXID0.4" and by["ENID1.4"].new_weight is None and by["ENID1.6"].new_weight == "NEW_14.6" and by["e1"].intervalgroup is None and by["in"].exid == "enid"
    assert [r.stat_day for r in readers.missing_days(spark, f"file://{tmp_path}", "202602").orderBy("stat_day").collect()] == [date(2026, 2, 5), date(2026, 2, 20), date(2026, 2, 28)]
    with pytest.raises(Exception):
        readers.missing_days(spark, f"file://{tmp_path}", "202603").collect()


def test_flow_at_the_anchor_trip_by_trip(spark):
    rng = np.random.default_rng(0)
    start = datetime(2025, 12, 20)
    trips = []
    for _ in range(300):
        path = [int(x) for x in rng.integers(0, 6, int(rng.integers(1, 5)))]
        at = start + timedelta(minutes=int(rng.integers(0, 60 * 24 * 30))) - timedelta(days=365 * int(rng.integers(0, 2)))
        trips.append((path[0], path[-1], path, [None if rng.random() < 0.1 else at + timedelta(minutes=50 * i) for i in range(len(path))], str(rng.integers(0, 2))))
    works = [(1, [4, 2], date(2026, 1, 1), date(2026, 1, 5)), (2, [5], date(2025, 12, 28), date(2026, 1, 2)), (3, [99], date(2026, 1, 1), date(2026, 1, 2))]
    t = spark.createDataFrame(trips, "enid int, exid int, path array<int>, times array<timestamp_ntz>, vehicle_type string")
    w = spark.createDataFrame(works, "works_id int, units array<int>, start date, end date")
    got = {(r.works_id, r.path_key, r.vehicle_type): (r.is_affected, r.anchor, list(r.affected), r.con_flow, r.sp_flow) for r in impact.anchor_flow(t, w).collect()}
    want = {}
    for wid, units, a, b in works:
        back = lambda d: d.replace(year=d.year - 1)
        ods = {(e, x) for e, x, p, _, _ in trips if set(p) & set(units)}
        flows = {}
        for e, x, p, times, kind in trips:
            if (e, x) in ods:
                hit = [u for u in units if u in p]
                anchor = (hit or p)[0]
                con, same = flows.setdefault((wid, "|".join(map(str, p))), (bool(hit), anchor, hit, {}, {}))[3:]
                for h in {v.replace(minute=0, second=0) for u, v in zip(p, times, strict=True) if u == anchor and v is not None}:
                    for table, first, last in ((con, a, b), (same, back(a), back(b))):
                        if first <= h.date() <= last:
                            table[kind] = table.get(kind, 0) + 1
        kinds = {k for f in flows.values() for k in (*f[3], *f[4])} or {"0"}
        for key, (hit, anchor, units_, con, same) in flows.items():
            for k in kinds:
                if not hit or con.get(k) or same.get(k):
                    want[*key, k] = (hit, anchor, units_, con.get(k, 0), same.get(k, 0))
    assert got == want and any(v[0] for v in want.values()) and any(not v[0] for v in want.values())
