"""Writers: idempotent partitions, reports with aliased headers, splits by day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import stored


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces the partitions that df holds and leaves others alone; running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_report(df: DataFrame, path: str, names: dict[str, str] | None = None, form: str = "csv") -> None:
    """A result for people: columns in the order and under the headers of names, arrays and structs as JSON in CSV."""
    names = names or {c: c for c in df.columns}
    kinds = dict(df.dtypes)
    flat = lambda c: F.to_json(F.col(c)) if form == "csv" and kinds[c].startswith(("array", "struct", "map")) else F.col(c)
    out = df.select(*(flat(c).alias(alias) for c, alias in names.items()))
    (out.write.mode("overwrite").option("header", True).csv if form == "csv" else out.write.mode("overwrite").json)(path)


def clamped_day(time: Column, first: str, last: str) -> Column:
    """The day of a time, not before first nor after last; null stays null."""
    return F.when(time.isNotNull(), F.greatest(F.to_date(F.lit(first)), F.least(F.to_date(F.lit(last)), F.to_date(time))))


def split_by_day(df: DataFrame, time: str, first: str, last: str, path: str) -> None:
    """A month's rows as one folder a day; rows outside the month go to its first or last day."""
    df.withColumn("stat_day", clamped_day(F.col(time), first, last)).write.mode("overwrite").partitionBy("stat_day").option("header", True).csv(path)


def between_days(df: DataFrame, time: str, first: str, last: str) -> DataFrame:
    return df.where(F.to_date(time).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def add_batch(rows: DataFrame, path: str, batch: int, keys: Sequence[str], measures: Sequence[str]) -> None:
    """Keeps the sums of one batch in its own place of the ledger at path. A batch that comes again takes the place of what it was, so it counts once.

    The ledger has folders kind=batch/no=N, and kind=base/no=N for all batches up to N once they are folded together.
    """
    sums = rows.groupBy(*keys).agg(*(F.sum(m).cast("bigint").alias(m) for m in measures))
    overwrite_partitions(sums.withColumns({"kind": F.lit("batch"), "no": F.lit(batch).cast("bigint")}), path, ["kind", "no"])


def ledger_rows(spark: SparkSession, path: str, keys: dict[str, str], measures: Sequence[str]) -> DataFrame:
    """Rows of the ledger that count: the last base and the batches after it. keys: names and types."""
    schema = ", ".join([*(f"`{k}` {kind}" for k, kind in keys.items()), *(f"`{m}` bigint" for m in measures), "kind string", "no bigint"])
    rows = spark.read.schema(schema).parquet(path)
    last = rows.where("kind = 'base'").agg(F.coalesce(F.max("no"), F.lit(-1))).first()[0]  # one number
    return rows.where(((F.col("kind") == "base") & (F.col("no") == last)) | ((F.col("kind") == "batch") & (F.col("no") > last)))


def ledger_totals(spark: SparkSession, path: str, keys: dict[str, str], measures: Sequence[str]) -> DataFrame:
    return ledger_rows(spark, path, keys, measures).groupBy(*keys).agg(*(F.sum(m).cast("bigint").alias(m) for m in measures))


def fold_ledger(spark: SparkSession, path: str, keys: dict[str, str], measures: Sequence[str]) -> int:
    """Writes a base of all batches so far and returns the last one's number; batches up to it that come again change nothing."""
    rows = ledger_rows(spark, path, keys, measures)
    last = rows.agg(F.max("no")).first()[0]
    if last is None:
        return -1
    sums = stored(rows.groupBy(*keys).agg(*(F.sum(m).cast("bigint").alias(m) for m in measures)), "ledger-base")
    overwrite_partitions(sums.withColumns({"kind": F.lit("base"), "no": F.lit(last).cast("bigint")}), path, ["kind", "no"])
    return last


def accumulate_stream(rows: DataFrame, path: str, keys: Sequence[str], measures: Sequence[str], checkpoint: str):
    """Starts a stream that adds each micro-batch to the ledger. After a failure Spark gives the last batch again, under its old number."""
    writer = rows.writeStream.foreachBatch(lambda batch, no: add_batch(batch, path, no, keys, measures))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of old whose columns differ from new's of the same keys (nulls equal each other), with new's values; keys that new lacks, or has more than once, aren't changed by it."""
    one = new.groupBy(*keys).agg(*(F.first(c).alias(f"_{c}") for c in columns), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))
    found = old.join(one, list(keys)).where(differs)
    return found.select(*(F.col(f"_{c}").alias(c) if c in columns else F.col(c) for c in old.columns))


def write_changes(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], columns: Sequence[str], by: Sequence[str]) -> int:
    """Writes new's values of the columns into the table at path, which is partitioned by `by`, and returns how many rows changed.

    Only partitions with a changed row are written again, from a stored copy; files of all others stay as they are. Running it again changes nothing.
    """
    old = spark.read.parquet(path)
    changed = stored(changed_rows(old, new, keys, columns), "changes")
    n = changed.count()
    if n:
        touched = old.join(changed.select(*by).distinct(), list(by), "left_semi")
        named = changed.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_changed"))
        merged = touched.join(named, list(keys), "left").select(*(F.when(F.col("_changed"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))
        overwrite_partitions(stored(merged, "changes-merged"), path, by)
    return n
