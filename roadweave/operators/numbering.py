"""Numbers and sums that run over a whole table, without a task that sees all rows.

Rows are dealt to ranges of the order, sorted within each, and written once with their place in the range and the range's sum so
far. The counts and sums of the ranges, a row each, then give what comes before a range, and that is added. Rows with equal order
keys are told apart by a hash of the whole row, so that one value that many rows share doesn't fall into one range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import stored


def _in_ranges(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str], ranges: int | None) -> DataFrame:
    """df, stored, with _range, the range's number, _row, a row's place in it from 1, and each of sums (whole numbers) up to the row."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(c) if isinstance(c, str) else c for c in order), F.xxhash64(*df.columns)]
    # the lower 33 bits of the id count a partition's rows
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumns({"_range": F.spark_partition_id(), "_row": place})

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = dict.fromkeys(sums, 0)
        for batch in batches:
            for c in sums:
                so_far = pc.add(pc.cumulative_sum(batch[c]), last[c])
                last[c] = so_far[-1].as_py() if len(so_far) else last[c]
                batch = batch.set_column(batch.schema.get_field_index(c), c, so_far)
            yield batch

    if sums:
        dealt = dealt.mapInArrow(grow, ", ".join(f"`{c}` {kind}" for c, kind in dealt.dtypes))
    return stored(dealt, "ranges")


def _shifted(parts: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """parts with what all earlier ranges hold: totals names the new columns and gives a range's total. The ranges' totals, a row a range, meet on the driver."""
    found = parts.groupBy("_range").agg(*(total.alias(c) for c, total in totals.items())).orderBy("_range").collect()
    rows, before = [], [0] * len(totals)
    for r in found:
        rows.append((r["_range"], *before))
        before = [b + r[c] for b, c in zip(before, totals, strict=True)]
    shift = parts.sparkSession.createDataFrame(rows, "_range int, " + ", ".join(f"`{c}` bigint" for c in totals))
    return parts.join(F.broadcast(shift), "_range")


def numbered(df: DataFrame, order: Sequence[Column | str], out: str = "n", ranges: int | None = None) -> DataFrame:
    """df with `out`, each row's number in the order, from 1 over the whole table. Ties are broken by a hash of the row; no rows, no numbers.

    Runs a job when called: the table is dealt to ranges (as many as shuffle partitions) and stored.
    """
    parts = _in_ranges(df, order, [], ranges)
    return _shifted(parts, {"_before": F.count("*")}).withColumn(out, F.col("_row") + F.col("_before")).select(*df.columns, out)


def running_sums(df: DataFrame, order: Sequence[Column | str], sums: dict[str, str], ranges: int | None = None) -> DataFrame:
    """df with sums of whole numbers from the first row of the order to each: sums names the new columns and what they add up. A null counts as 0.

    Rows with equal order keys follow each other in the order of a hash of the row. Runs a job when called, as `numbered` does.
    """
    names = {c: f"_{i}_sum" for i, c in enumerate(sums)}
    whole = df.withColumns({names[c]: F.coalesce(F.col(of).cast("bigint"), F.lit(0)).cast("bigint") for c, of in sums.items()})
    parts = _in_ranges(whole, order, list(names.values()), ranges)
    shifted = _shifted(parts, {f"_{c}_before": F.max_by(n, "_row") for c, n in names.items()})
    return shifted.select(*df.columns, *((F.col(n) + F.col(f"_{c}_before")).alias(c) for c, n in names.items()))


def grown_ids(old: DataFrame, rows: DataFrame, keys: Sequence[str], id_col: str = "id", ranges: int | None = None) -> DataFrame:
    """(keys, id) of each key that rows have and old lacks, numbered after old's largest id in the order of the keys; old: keys, id.

    So ids are dense and stay: a key that has one keeps it, and a second run over the same rows adds none. Nulls in keys are a value
    of their own. Runs jobs when called, as `numbered` does.
    """
    mine = rows.select(*keys).distinct()
    named = old.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (mine[k].eqNullSafe(named[f"_{k}"]) for k in keys))
    new = numbered(mine.join(named, same, "left_anti"), keys, id_col, ranges)
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).first()[0]  # one number
    return new.withColumn(id_col, F.col(id_col) + F.lit(top))


def keep_ids(path: str, rows: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """The stored table (keys, id) at path after ids for keys that it lacks are added to it; the table is made if it isn't there."""
    spark = rows.sparkSession
    schema = ", ".join(f"`{k}` {kind}" for k, kind in rows.select(*keys).dtypes) + f", `{id_col}` bigint"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        spark.createDataFrame([], schema).write.parquet(path)
    grown_ids(spark.read.schema(schema).parquet(path), rows, keys, id_col).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def with_ids(rows: DataFrame, ids: DataFrame, columns: dict[str, str], key: str, id_col: str = "id") -> DataFrame:
    """rows with the ids of several of their columns: columns names each column and the new one for its id; null where ids (key, id) has none."""
    for i, (column, out) in enumerate(columns.items()):
        named = ids.select(F.col(key).alias(f"_key{i}"), F.col(id_col).alias(out))
        rows = rows.join(named, F.col(column) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
    return rows
