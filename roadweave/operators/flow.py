"""Hourly flow, path frequencies, canonical paths and the inverted index of sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import asof_join


def hourly_flow(records: DataFrame, path: str = "path", times: str = "times", keys: tuple[str, ...] = ("vehicle_type",)) -> DataFrame:
    """Flow of each unit, hour and key: a record counts once for a unit and hour, however often it passes.

    The record's visits are made distinct in its own array, so the only shuffle is that of partially counted groups.
    Visits without a time are left out.
    """
    visits = F.transform(F.arrays_zip(F.col(path).alias("unit"), F.col(times).alias("at")), lambda v: F.struct(v["unit"].alias("unit"), F.date_trunc("hour", v["at"]).alias("stat_hour")))
    each = records.select(*keys, F.explode(F.array_distinct(F.filter(visits, lambda v: v["stat_hour"].isNotNull()))).alias("v"))
    return each.groupBy("v.unit", "v.stat_hour", *keys).agg(F.count("*").alias("flow_cnt"))


def bridge(paths: DataFrame, id_col: str, path: str = "path") -> DataFrame:
    """(section, id): which paths visit a section. Distinct within each path, without a shuffle."""
    return paths.select(F.explode(F.array_distinct(path)).alias("section"), id_col)


def paths_through(paths: DataFrame, index: DataFrame, sections: list, id_col: str) -> DataFrame:
    """Paths that visit any of the sections, found through the index."""
    return paths.join(index.where(F.col("section").isin(sections)).select(id_col), id_col, "left_semi")


def paths_overlapping(paths: DataFrame, sections: list, path: str = "path") -> DataFrame:
    """The same without an index: one scan."""
    return paths.where(F.arrays_overlap(F.col(path), F.array(*map(F.lit, sections))))


def path_frequency(records: DataFrame, keys: list[str]) -> DataFrame:
    return records.groupBy(*keys).agg(F.count("*").alias("ig_count"))


def ranked_frequency(freq: DataFrame, group: list[str], tie: str) -> DataFrame:
    """Rank of each repaired path within its group by frequency (ties share a rank) and a row number that tie decides."""
    by = Window.partitionBy(*group).orderBy(F.desc("ig_count"))
    return freq.withColumn("ig_rank", F.rank().over(by)).withColumn("row_no", F.row_number().over(by.orderBy(F.desc("ig_count"), tie)))


def best_path_map(freq: DataFrame, group: list[str], tie: str) -> DataFrame:
    """The most frequent path of each group with its share of the group's trips, four decimals."""
    total = F.sum("ig_count").over(Window.partitionBy(*group))
    share = F.round(F.col("ig_count").cast("decimal(20,0)") / F.nullif("total_trip_cnt", F.lit(0)), 4).cast("decimal(5,4)")
    return ranked_frequency(freq.withColumn("total_trip_cnt", total), group, tie).where("row_no = 1").withColumn("path_freq_ratio", share).drop("row_no", "ig_rank")


def section_path(paths: DataFrame, section_of: DataFrame, id_col: str, path: str = "path") -> DataFrame:
    """(id, sections): units mapped to section numbers, units without one dropped, neighbours collapsed. section_of: unit, section.

    The map is joined to exploded units by whatever join its size demands, and the order restored from the position.
    """
    from ..functions.paths import adjacent_dedup

    each = paths.select(id_col, F.posexplode(path).alias("pos", "unit")).join(section_of, "unit")
    listed = each.groupBy(id_col).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "section"))), lambda x: x["section"]).alias("sections"))
    return listed.withColumn("sections", adjacent_dedup(F.col("sections")))


def od_key(*columns: str) -> Column:
    """A deterministic surrogate id."""
    return F.xxhash64(*columns)


def asof_version(months: DataFrame, versions: DataFrame, default: str = "202603", month: str = "month", version: str = "version") -> DataFrame:
    """Each distinct month with the latest version not after it, or default."""
    known = versions.select(F.col(version).alias(month), F.col(version).alias("_version")).distinct()
    found = asof_join(months.select(month).distinct(), known, month, value="_version")
    return found.select(month, F.coalesce("_version", F.lit(default)).alias(version))
