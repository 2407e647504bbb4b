"""Readers of dimensions and path records, places of nodes, lines."""

import math

from pyspark.sql import functions as F

from roadweave.functions import measures
from roadweave.operators import graph
from roadweave.sources import readers


def test_places_of_nodes(spark):
    gantries = spark.createDataFrame([("G1010", " 1.5", "2"), ("G1010", "9", "9"), ("G2", "x", "3"), (" ", "1", "1"), (None, "1", "1")], "id string, lng string, lat string")
    stations = spark.createDataFrame([("G1", "7", "7"), ("S1010", "4", "")], "code string, entryLng string, entryLat string")
    fallback = spark.createDataFrame([("D", "5", "6")], "id string, startlng string, startlat string")
    rows = lambda df: {r.node_id: (r.lon, r.lat, r.source) for r in df.collect()}
    assert rows(readers.node_places(gantries, stations, fallback)) == {"G1": (1.5, 2.0, "gantry"), "G2": (None, 3.0, "gantry"), "S1010": (4.0, None, "station")}
    assert rows(readers.node_places(gantries.limit(0), stations.limit(0), fallback)) == {"D": (5.0, 6.0, "db")}


def test_dimension_and_path_records(spark, tmp_path):
    raw = spark.createDataFrame([("7", "x", "1.5"), ("a", "y", None)], "Nr string, Name string, Km string")
    found = readers.load_dimension(raw, {"Nr": "id", "Name": "name", "Km": "km"}, {"id": "int", "km": "double"}, "202512")
    assert [tuple(r) for r in found.collect()] == [(7, "x", 1.5, "202512"), (None, "y", None, "202512")] and dict(found.dtypes)["id"] == "int"
    (tmp_path / "p.csv").write_text("record_id,enid,exid,path,flow\nr1,A,C,A|B |C,12.5\nr2,A,B,,x\nr3,A,B,A||B,\n")
    rows = {r.record_id: (r.path, r.flow) for r in readers.read_path_records(spark, f"file://{tmp_path}/p.csv").collect()}
    assert rows == {"r1": (["A", "B", "C"], 12.5), "r2": (None, 0.0), "r3": (["A", "B"], 0.0)}


def test_lines(spark):
    df = spark.createDataFrame([(0.0, 0.0, [(0.0, 0.01), (0.02, 0.01)]), (0.03, 0.01, [(0.0, 0.01), (0.02, 0.01)]), (1.0, 1.0, [(1.0, 1.0)]), (1.0, 1.0, [])], "x double, y double, line array<struct<lon:double,lat:double>>")
    rows = df.select(measures.distance_to_line_m(F.col("x"), F.col("y"), F.col("line")), measures.line_length_m(F.col("line")), measures.wkt_line(F.col("line"))).collect()
    degree = measures.EARTH_M * math.pi / 180
    assert abs(rows[0][0] - 0.01 * degree) < 1e-6 and abs(rows[1][0] - 0.01 * degree) < 0.01 and rows[2][0] == 0 and rows[3][0] is None
    assert abs(rows[0][1] - 0.02 * degree * math.cos(math.radians(0.01))) < 0.01 and rows[2][1] == 0
    assert rows[0][2] == "LINESTRING(0.0 0.01, 0.02 0.01)"
    kinds = spark.createDataFrame([("POINT(1 2)",), ("SRID=4326;linestring (1 2, 3 4)",), ("nothing",), (None,)], "w string").select(measures.geometry_type(F.col("w")), measures.with_srid(F.col("w")))
    assert [tuple(r)[0] for r in kinds.collect()] == ["POINT", "LINESTRING", None, None] and kinds.first()[1] == "SRID=4326;POINT(1 2)"


def test_graph_of_relations(spark):
    raw = spark.createDataFrame([("a", "b", 0, "v"), ("a", "b", 5, "v"), ("b", "c", None, "v"), ("c", None, 1, "v"), ("c", "d", 1, "w"), ("c", "a", 7, "v")], "src string, dst string, miles int, version string")
    assert {tuple(r) for r in graph.built_edges(raw, "v").collect()} == {("a", "b", 1, 1e9), ("b", "c", 1, 1e9), ("c", "a", 7, 1e9)}
