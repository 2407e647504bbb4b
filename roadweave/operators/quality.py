"""Data-quality checks as DataFrames of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) in one scan."""
    counts = df.agg(*(F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("nulls")) for c in columns))).alias("x")).select("x.*")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def out_of_range(df: DataFrame, ranges: dict[str, tuple[Column | None, Column | None]], id_col: str) -> DataFrame:
    """(id, column_name) of values outside their closed range."""
    parts = []
    for c, (low, high) in ranges.items():
        bad = F.lit(False)
        bad = bad | (F.col(c) < low) if low is not None else bad
        bad = bad | (F.col(c) > high) if high is not None else bad
        parts.append(F.when(bad, F.lit(c)))
    return df.select(id_col, F.explode(F.array_compact(F.array(*parts))).alias("column_name"))


def recomputed(df: DataFrame, stored: Column, right: Column, tolerance: float) -> DataFrame:
    return df.where(F.abs(stored - right) > tolerance)


def day_gaps(df: DataFrame, key: str, day: str) -> DataFrame:
    """Days of a key that follow another after more than one day."""
    by = Window.partitionBy(key).orderBy(day)
    found = df.select(key, day).distinct().withColumn("previous_day", F.lag(day).over(by))
    return found.withColumn("gap_days", F.datediff(day, "previous_day")).where("gap_days > 1")


def orphans(df: DataFrame, parents: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(parents.select(*on).distinct(), list(on), "left_anti")


def differing_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.0) -> DataFrame:
    """Keys whose measures differ by more than the tolerance; a missing key counts as 0."""
    both = left.select(*keys, F.col(measure).alias("left_value")).join(right.select(*keys, F.col(measure).alias("right_value")), list(keys), "full").fillna(0, ["left_value", "right_value"])
    return both.where(F.abs(F.col("left_value") - F.col("right_value")) > tolerance)


def schema_differences(df: DataFrame, expected: StructType) -> list[str]:
    """What a table lacks, has too much or has in another type."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in expected}
    return sorted([f"missing {c}" for c in want.keys() - have.keys()] + [f"unexpected {c}" for c in have.keys() - want.keys()] + [f"{c} is {have[c].simpleString()}, not {want[c].simpleString()}" for c in want.keys() & have.keys() if want[c] != have[c]])


def consistency(rows: DataFrame, ratio: str) -> DataFrame:
    """Number of rows whose ratio is high (0.9 or more), medium (0.7 or more) or low; null counts as low."""
    level = F.when(F.col(ratio) >= 0.9, "high").when(F.col(ratio) >= 0.7, "medium").otherwise("low")
    return rows.groupBy(level.alias("consistency")).agg(F.count("*").alias("n"))


def map_summary(best: DataFrame, freq: DataFrame, version: str, od: tuple[str, str], path: str, ratio: str) -> DataFrame:
    """One row a version: rows of the map of best paths and of the frequencies behind it, pairs and paths in the map, and the mean, least and greatest ratio.

    Versions that only one of both has are shown too, with 0 rows of the other.
    """
    of_map = best.groupBy(version).agg(
        F.count("*").alias("map_count"), F.countDistinct(*od).alias("od_pair_count"), F.countDistinct(path).alias("numpath_count"),
        *(f(F.col(ratio).cast("double")).alias(f"{name}_freq_ratio") for name, f in (("avg", F.avg), ("min", F.min), ("max", F.max))),
    )
    found = of_map.join(freq.groupBy(version).agg(F.count("*").alias("freq_count")), version, "full")
    return found.fillna(0, ["map_count", "od_pair_count", "numpath_count", "freq_count"])


def run_summary(rows: DataFrame, different: dict[str, str], total: str, time: str) -> DataFrame:
    """One row of a run's figures: rows, different values (name to column), the summed measure (0 without rows) and the first and last time."""
    return rows.agg(F.count("*").alias("total_records"), *(F.countDistinct(c).alias(f"unique_{name}") for name, c in different.items()), F.coalesce(F.sum(total), F.lit(0)).alias(f"total_{total}"), F.min(time).alias(f"min_{time}"), F.max(time).alias(f"max_{time}"))


def double_assignments(rows: DataFrame, keys: Sequence[str], kind: str = "route_type") -> DataFrame:
    """Keys that more than one row takes, and how many do; rows of kind `unassigned` or of none don't count."""
    return rows.where(F.col(kind) != "unassigned").groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def record_errors(origin: Column, destination: Column, first: Column, last: Column, sections: Column) -> Column:
    """Codes of what is wrong with a record's texts, in a fixed order; an empty array if nothing is.

    Days are yyyy-MM-dd; their order is judged only where both are days. Sections are numbers joined by `|`, of which
    empty ones are passed over.
    """
    missing = lambda c: F.coalesce(c == "", F.lit(True))
    day = lambda c: F.try_to_date(c, "yyyy-MM-dd")
    odd = F.exists(F.split(sections, r"\|"), lambda s: (F.trim(s) != "") & ~F.trim(s).rlike(r"^[+-]?[0-9]+$"))
    found = {
        "origin missing": missing(origin), "destination missing": missing(destination), "first day unreadable": day(first).isNull(), "last day unreadable": day(last).isNull(),
        "first day after last": day(first) > day(last), "sections missing": missing(sections), "section not a number": odd,
    }
    return F.array_compact(F.array(*(F.when(wrong, code) for code, wrong in found.items())))


def outside(rows: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values of a column that aren't among the allowed ones (null neither), and how often each is met."""
    return rows.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).groupBy(column).agg(F.count("*").alias("n"))
