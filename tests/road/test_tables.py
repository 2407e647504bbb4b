"""Readers, writers, streams and the registered queries."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from roadweave.operators import flow, impact, mining, quality, warehouse
from roadweave.plans import graph_queries, more_queries, queries, report_queries  # noqa: F401
from roadweave.sources import readers, sinks
from roadweave.streaming import trips as streams

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    df = queries.QUERIES[name](spark, SF)
    other = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    theirs = sorted(repr([plain(r[other.columns.index(c)]) for c in columns]) for r in other.fetchall())
    assert mine == theirs


def test_trip_csv_with_and_without_header(spark, tmp_path):
    with_header, without = tmp_path / "a.csv", tmp_path / "b.csv"
    with_header.write_text("enid,exid,intervalgroup,other\nE1,X1,A|B|C,foo\nE2,X2,D|E|F,bar\n")
    without.write_text("X3,E3,G|H,2026-03-15 10:00:00|2026-03-15 10:10:00,V1,,2026-03-15 09:50:00,bad,p, 3 \n")
    raw = readers.read_trip_csv(spark, [f"file://{with_header}", f"file://{without}"])
    rows = {r["enid"]: r for r in readers.typed_trips(raw).collect()}
    assert rows["E1"]["path"] == ["A", "B", "C"] and rows["E1"]["vehicle_type"] == "0"
    assert rows["E3"]["vehicle"] == "V1" and rows["E3"]["vehicle_type"] == "3" and rows["E3"]["extime"] is None and len(rows["E3"]["times"]) == 2


def test_daily_split_and_read(spark, tmp_path):
    df = spark.sql("select * from values (1, timestamp_ntz '2026-02-27 10:00:00'), (2, timestamp_ntz '2026-03-05 10:00:00'), (3, timestamp_ntz '2026-04-02 10:00:00') t(id, extime)")
    sinks.split_by_day(df, "extime", "2026-03-01", "2026-03-31", f"file://{tmp_path}/out")
    assert {d for d in os.listdir(tmp_path / "out") if d.startswith("stat_day")} == {"stat_day=2026-03-01", "stat_day=2026-03-05", "stat_day=2026-03-31"}
    month = tmp_path / "202603"
    month.mkdir()
    (month / "data_20260305.csv").write_text(",".join(readers.TRIP_COLUMNS) + "\n" + "X,E" + "," * 13 + "\n")
    found = readers.read_daily_trips(spark, f"file://{tmp_path}", "202603").collect()
    assert [str(r["stat_day"]) for r in found] == ["2026-03-05"] and found[0]["exid"] == "X"
    assert readers.daily_files(spark, f"file://{tmp_path}", "202603").count() == 1


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    for _ in range(2):
        sinks.overwrite_partitions(df, f"file://{tmp_path}/t", ["day"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b")], "v int, day string"), f"file://{tmp_path}/t", ["day"])
    assert sorted((r["v"], r["day"]) for r in spark.read.parquet(f"file://{tmp_path}/t").collect()) == [(1, "a"), (9, "b")]
    sinks.write_report(df.withColumn("x", F.array(F.lit(1))), f"file://{tmp_path}/r", {"v": "Value", "x": "List"})
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/r").columns == ["Value", "List"]


def test_sources_with_priority_and_paging(spark):
    a, b = spark.createDataFrame([("u", 1.0)], "node string, lon double"), spark.createDataFrame([("u", 2.0), ("v", 3.0)], "node string, lon double")
    assert {(r["node"], r["lon"]) for r in readers.with_priority([a, b], "node").collect()} == {("u", 1.0), ("v", 3.0)}
    assert [r["id"] for r in readers.page(spark.range(50), F.col("id") % 2 == 0, ["id"], number=2, size=5).collect()] == [10, 12, 14, 16, 18]


def test_mid_trip_pair(spark):
    rows = [(1, "V1", "EN1", "MID", "2026-03-01 08:00:00", "2026-03-01 11:00:00"), (2, "V1", "MID2", "EX1", "2026-03-01 12:00:00", "2026-03-01 13:00:00"), (3, "V2", "EN1", "MID", "2026-03-01 08:00:00", "2026-03-01 09:00:00"), (4, "V2", "MID2", "EX1", "2026-03-01 16:00:00", "2026-03-01 17:00:00")]
    df = spark.createDataFrame(rows, "event_id int, vehicle string, enid string, exid string, s string, e string").select("event_id", "vehicle", "enid", "exid", F.col("s").cast("timestamp_ntz").alias("entime"), F.col("e").cast("timestamp_ntz").alias("extime"))
    found = impact.mid_trip_exits(df, spark.createDataFrame([("EN1", "EX1")], "enid string, exid string")).collect()
    assert [(r["vehicle"], r["next_event_id"]) for r in found] == [("V1", 2)]


def test_greedy_prefix_equals_a_loop(spark):
    flows = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "c", 9), (2, "z", 3)], "od int, p string, flow int")
    found = {(r["od"], r["p"]): r["allocated"] for r in mining.greedy_prefix(flows, spark.createDataFrame([(1, 12), (2, 2)], "od int, flow_x int"), ["od"], "flow", "p").collect()}
    assert found == {(1, "a"): 5, (1, "b"): 5, (1, "c"): 2, (2, "z"): 2}


def test_quality_and_upserts(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, 99)], "k int, v int")
    assert [tuple(r) for r in quality.null_counts(df, ["k", "v"]).collect()] == [("k", 0), ("v", 1)]
    assert [tuple(r) for r in quality.out_of_range(df, {"v": (F.lit(0), F.lit(10))}, "k").collect()] == [(2, "v")]
    assert quality.schema_differences(df, StructType.fromDDL("k bigint, w int")) == ["k is int, not bigint", "missing w", "unexpected v"]
    old, new = spark.createDataFrame([(1, 1, "old"), (2, 5, "old")], "k int, at int, v string"), spark.createDataFrame([(1, 1, "new"), (3, 0, "new")], "k int, at int, v string")
    assert {(r["k"], r["v"]) for r in warehouse.upsert(old, new, ["k"], "at").collect()} == {(1, "new"), (2, "old"), (3, "new")}


def test_asof_version(spark):
    months = spark.createDataFrame([("202401",), ("202512",)], "month string")
    found = {r["month"]: r["version"] for r in flow.asof_version(months, spark.createDataFrame([("202412",), ("202507",)], "version string")).collect()}
    assert found == {"202401": "202603", "202512": "202507"}


def test_streams_equal_batches(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts").coalesce(1).select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("unit"), F.lit(1).alias("vehicle_type"))
    source.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"file://{tmp_path}/in")
    q = streams.hourly_counts(stream).writeStream.outputMode("update").format("memory").queryName("hourly").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = source.groupBy(F.date_trunc("hour", "at").alias("stat_hour"), "unit", "vehicle_type").agg(F.count("*").alias("flow_cnt"))
    assert spark.table("hourly").groupBy("stat_hour", "unit").agg(F.max("flow_cnt").alias("n")).join(batch, ["stat_hour", "unit"]).where("n <> flow_cnt").count() == 0
    assert spark.table("hourly").select("stat_hour", "unit").distinct().count() == batch.count()


def test_continued_trips_stream(spark, tmp_path):
    rows = [(7, 1, "a", "b", "2026-03-01 08:00:00", "2026-03-01 09:00:00"), (7, 2, "c", "d", "2026-03-01 10:00:00", "2026-03-01 11:00:00"), (7, 3, "d", "e", "2026-03-01 12:00:00", "2026-03-01 13:00:00"), (8, 4, "a", "b", "2026-03-01 08:00:00", "2026-03-01 09:00:00")]
    df = spark.createDataFrame(rows, "vehicle bigint, event_id bigint, enid string, exid string, s string, e string").select("vehicle", "event_id", "enid", "exid", F.col("s").cast("timestamp").alias("entime"), F.col("e").cast("timestamp").alias("extime"))
    df.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"file://{tmp_path}/in")
    q = streams.continued_trips(stream).writeStream.outputMode("append").format("memory").queryName("continued").option("checkpointLocation", f"file://{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r["event_id"], r["next_event_id"]) for r in spark.table("continued").collect()] == [(1, 2)]
