"""Readers of trips, path records and dimensions. Files are read by Spark; one job tells which of them have a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.paths import split_path

#: Columns of raw trip files in the order of files without a header. Fixed values.
TRIP_COLUMNS = ("exid", "enid", "intervalgroup", "intervaltimegroup", "envehicleid", "exvehicleid", "entime", "extime", "passid", "new_vehicletype", "exvehicleclass", "envehicleclass", "mediatype", "new_distance", "new_weight")
HEADER_WORDS = ("enid", "exid", "intervalgroup")


def file_headers(spark: SparkSession, paths: str | Sequence[str], encoding: str = "utf-8") -> dict[str, list[str]]:
    """Column names in the first line of each file that has some, by file, in one job over all of them. A file is told by its path.

    A first line names columns if any of HEADER_WORDS is in it. There is a row a file that has a header; a month has 31 files.
    """
    lines = spark.read.option("encoding", encoding).text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    # a task reads the lines of a file's first block in order
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "n").alias("value"))
    first = first.where(F.col("value").rlike("|".join(HEADER_WORDS))).collect()
    return {r["path"]: [c.strip().strip('"') for c in r["value"].lstrip("\ufeff").rstrip("\r").split(",")] for r in first}


def read_trip_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = TRIP_COLUMNS, encoding: str = "utf-8") -> DataFrame:
    """All columns as text, by name where files have a header and by position where not; what a file lacks is null, short rows are filled with nulls.

    One job finds the headers; files of one header are one scan, however many they are. Files without one have all of TRIP_COLUMNS in order.
    """
    heads = file_headers(spark, paths, encoding)
    every = [r["path"] for r in spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path")).collect()]  # names only, contents aren't read
    forms: dict[tuple, list[str]] = {}
    for path in sorted(every):
        forms.setdefault(tuple(heads.get(path, ())), []).append(path)
    out = None
    for header, files in sorted(forms.items()):
        names = list(header or TRIP_COLUMNS)
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        found = spark.read.option("encoding", encoding).option("mode", "PERMISSIVE").option("header", bool(header)).option("enforceSchema", True).schema(schema).csv(files)
        found = found.select(*(F.col(f"c{names.index(c)}").alias(c) if c in names else F.lit(None).cast("string").alias(c) for c in columns))
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns)) if out is None else out


def daily_files(spark: SparkSession, folder: str, month: str) -> DataFrame:
    """(path, stat_day) of {folder}/{yyyymm}/data_{yyyymmdd}.csv; a month without files raises."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "data_*.csv").load(f"{folder}/{month}").select("path")
    found = found.withColumn("stat_day", F.to_date(F.regexp_extract("path", r"data_(\d{8})\.csv$", 1), "yyyyMMdd"))
    if found.isEmpty():
        raise FileNotFoundError(f"no daily files in {folder}/{month}")
    return found


def missing_days(spark: SparkSession, folder: str, month: str) -> DataFrame:
    """stat_day of each day of the month that has no file, or an empty one."""
    first = F.to_date(F.lit(f"{month}01"), "yyyyMMdd")
    days = spark.range(1).select(F.explode(F.sequence(first, F.last_day(first))).alias("stat_day"))
    return days.join(daily_files(spark, folder, month).select("stat_day"), "stat_day", "left_anti")


def read_daily_trips(spark: SparkSession, folder: str, month: str, header: bool = True) -> DataFrame:
    """A month's daily files with the day of each row's file."""
    found = spark.read.option("header", header).schema(StructType.fromDDL(", ".join(f"`{c}` string" for c in TRIP_COLUMNS))).option("enforceSchema", True).option("pathGlobFilter", "data_*.csv").csv(f"{folder}/{month}")
    return found.withColumn("stat_day", F.to_date(F.regexp_extract("_metadata.file_name", r"data_(\d{8})", 1), "yyyyMMdd"))


def typed_trips(raw: DataFrame) -> DataFrame:
    """Raw trips with arrays and timestamps; the type is `0` where empty, the exit plate counts before the entry plate, times that can't be read are null."""
    time = lambda x: F.try_to_timestamp(F.trim(x), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return raw.select(
        "enid", "exid", split_path(F.col("intervalgroup")).alias("path"), F.transform(split_path(F.col("intervaltimegroup")), time).alias("times"),
        F.coalesce(F.nullif(F.trim("exvehicleid"), F.lit("")), F.trim("envehicleid")).alias("vehicle"), time(F.col("entime")).alias("entime"), time(F.col("extime")).alias("extime"),
        F.coalesce(F.nullif(F.trim("new_vehicletype"), F.lit("")), F.lit("0")).alias("vehicle_type"),
    )


def read_path_records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, enid, exid, path, flow from a CSV file with a header; a flow that is no number is 0."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select("record_id", "enid", "exid", split_path(F.col("path")).alias("path"), F.coalesce(F.try_to_number("flow", F.lit("999999999D999999")).cast("double"), F.expr("try_cast(flow as double)"), F.lit(0.0)).alias("flow"))


def load_dimension(raw: DataFrame, names: dict[str, str], types: dict[str, str], version: str) -> DataFrame:
    """A dimension from its raw form: columns renamed and cast (null where that fails), with the version they belong to."""
    return raw.select(*(F.expr(f"try_cast(`{old}` as {types.get(new, 'string')})").alias(new) for old, new in names.items()), F.lit(version).alias("version_yyyymm"))


def with_priority(sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of several sources of one shape, one for each key: that of the earliest source."""
    both = None
    for i, df in enumerate(sources):
        df = df.withColumn("_priority", F.lit(i))
        both = df if both is None else both.unionByName(df)
    by = Window.partitionBy(key).orderBy("_priority", *[c for c in both.columns if c not in (key, "_priority")])
    return both.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n", "_priority")


#: What a gantry's id has behind the id of its section. Fixed value.
GANTRY_TAIL = "010"


def node_places(gantries: DataFrame, stations: DataFrame, fallback: DataFrame) -> DataFrame:
    """node_id, lon, lat and source of each node: from gantries (id, lng, lat) before stations (code, entryLng, entryLat); fallback (id, startlng, startlat) only if both are empty.

    A gantry's id without its tail names the node. Blank ids go, coordinates that are no numbers are null; of several rows of a node and source the one of the smallest id and
    coordinates counts. Runs a job when called, to see whether there is any gantry or station.
    """
    number = lambda c: F.expr(f"try_cast(trim(`{c}`) as double)")
    part = lambda df, i, x, y, name, order: df.select(F.trim(i).alias("id"), number(x).alias("lon"), number(y).alias("lat"), F.lit(name).alias("source"), F.lit(order).alias("_order"))
    files = part(gantries, "id", "lng", "lat", "gantry", 0).unionByName(part(stations, "code", "entryLng", "entryLat", "station", 1)).where("id <> ''")
    every = part(fallback, "id", "startlng", "startlat", "db", 2).where("id <> ''") if files.isEmpty() else files
    node = F.when((F.col("source") == "gantry") & F.endswith("id", F.lit(GANTRY_TAIL)), F.substring("id", F.lit(1), F.length("id") - len(GANTRY_TAIL))).otherwise(F.col("id"))
    best = every.groupBy(node.alias("node_id")).agg(F.min(F.struct("_order", "id", "lon", "lat", "source")).alias("b"))
    return best.select("node_id", "b.lon", "b.lat", "b.source")


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end, both included."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("stat_day"))


def page(df: DataFrame, where: Column | None = None, order: Sequence[str] = (), number: int = 1, size: int = 20) -> DataFrame:
    """One page of a result: filtered, in a stated order."""
    df = df if where is None else df.where(where)
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
