"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target in words. Its documents are then wanted p = target / source size times each: floor(p) copies for
sure, and one more with probability f = p - floor(p). Pivotal rounding decides the latter dependently: two documents with
fractions swap mass (words, so that the source's total stays as it is) until one fraction is 0 or 1; the other goes on to
the next. A group of documents thus ends with one undecided document at most. Groups are small hash buckets of a source;
their undecided rows meet in ever fewer groups, a reduction tree of Spark stages, and only the last one of a source is
rounded by itself. So a source's taken words miss its target by less than one document's size.

All draws come from hashes of the ids, and buckets from the number of documents, so reruns and other partitionings agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mix64, stored

WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
#: Documents of one source that a task rounds together, about; and undecided rows that the next level joins.
BUCKET_ROWS, FAN = 4096, 64


def word_count(text: str = "text"):
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(F.col(text), WORD_BREAKS), lambda x: x != "")), F.lit(0)).cast("bigint") if text else F.lit(0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes: source, size (words of the source). Adds target.

    The sources in code point order, null last, weigh `weights` in turn and share `share` times all words. A target stops
    at `most` times its source's size; the excess is shared again by weight until no target is above. That is a common
    level x with target = min(cap, weight * x), found by running sums in the order of cap / weight.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.row_number().over(order) - 1, F.lit(n)).cast("int") + 1))
    ranked = ranked.withColumn("_cap", F.col("size") * F.lit(float(most)))
    filling = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    run = ranked.withColumn("_left", F.sum("size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(filling), F.lit(0.0)))
    run = run.withColumn("_weights", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(filling), F.lit(0.0)))
    run = run.withColumn("_full", F.col("_w") * F.col("_left") >= F.col("_cap") * F.col("_weights"))
    rest = F.sum("size").over(every) * F.lit(float(share)) - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(every)
    weight = F.sum(F.when(F.col("_full"), F.lit(0.0)).otherwise(F.col("_w"))).over(every)
    run = run.withColumn("_rest", rest).withColumn("_weight", weight)
    return run.select("source", "size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * F.col("_rest") / F.nullif("_weight", F.lit(0.0))).alias("target"))


def pivot(size: np.ndarray, part: np.ndarray, draw: np.ndarray, last: bool) -> np.ndarray:
    """The fractions after pairing rows one after the other; at most one of those with a size stays between 0 and 1, none if last.

    draw: a 64-bit hash of each row, from which its uniform numbers come. Rows without words are rounded by themselves.
    """
    out = part.copy()
    uniform = ((mix64(draw) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    open_ = (out > 0) & (out < 1)
    alone = open_ & (size == 0)
    out[alone] = uniform[alone] < out[alone]
    at = -1
    for i in np.flatnonzero(open_ & (size > 0)).tolist():
        if at < 0:
            at = i
            continue
        a, b, x, y = float(size[at]), float(size[i]), float(out[at]), float(out[i])
        to_b, to_a = min(a * x, b * (1 - y)), min(b * y, a * (1 - x))
        if uniform[i] * (to_a + to_b) < to_a:  # the move's mean is zero
            full, empty = a * x + to_b >= 0 and to_b == a * x, to_b == b * (1 - y)
            out[at], out[i] = (0.0 if full else x - to_b / a), (1.0 if empty else y + to_b / b)
        else:
            full, empty = to_a == a * (1 - x), to_a == b * y
            out[at], out[i] = (1.0 if full else x + to_a / a), (0.0 if empty else y - to_a / b)
        for j in (at, i):
            if out[j] < 1e-12 or out[j] > 1 - 1e-12:
                out[j] = round(out[j])
        still = [j for j in (at, i) if 0 < out[j] < 1]
        at = still[0] if still else -1
    if last and at >= 0:
        out[at] = float((float(mix64(draw[at : at + 1] ^ np.uint64(0x9E3779B97F4A7C15))[0] >> np.uint64(11)) + 0.5) / 2.0**53 < out[at])
    return out


def _round(df: DataFrame, keys: list[str], last: bool) -> DataFrame:
    schema = df.schema

    def run(table: pa.Table) -> pa.Table:
        size, part, draw = (table[c].to_numpy() for c in ("_size", "_part", "_draw"))
        draw = np.ascontiguousarray(draw).view(np.uint64)
        order = np.lexsort((draw, -size))  # large documents first: what stays undecided tends to be small
        out = np.empty(len(order))
        out[order] = pivot(size[order], part[order], draw[order], last)
        i = table.schema.get_field_index("_part")
        return table.set_column(i, table.schema.field(i), pa.array(out))

    return df.groupBy(*keys).applyInArrow(run, schema)


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, keep: bool = False, words: Column | None = None) -> DataFrame:
    """Each row of docs with size, source_size, target (words), copies and taken = copies * size; with all its columns if keep, else id and source. words: its size, if that is known.

    Null and empty texts have size 0 and take no words. Rows that repeat are separate documents. Ids needn't be unique or
    set: a draw hashes id, source and size. If no document has a word, all targets are 0.
    An input column with the name of an added one is replaced.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    rest = [c for c in docs.columns if c not in added] if keep else list(dict.fromkeys([id_col, source]))
    rows = docs.select(*(F.col(f"`{c}`") for c in rest), (word_count(text) if words is None else words).alias("_size"))
    totals = rows.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum("_size").alias("size"), F.count("*").alias("n"))
    totals = stored(totals, "mixing-sources")
    targets = source_targets(totals.select("source", "size"), weights, share, most).select(F.col("source").alias("_source"), F.col("size").alias("_source_size"), F.col("target").alias("_target"))
    n = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = -(-n // BUCKET_ROWS) or 1
    p = F.coalesce(F.col("_target") / F.nullif("_source_size", F.lit(0)), F.lit(0.0))
    p = F.when(F.abs(p - F.round(p)) < 1e-12, F.round(p)).otherwise(p)
    rows = rows.join(stored(targets, "mixing-targets"), F.col(f"`{source}`").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_draw", F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{source}`"), F.col("_size"))).withColumn("_p", p)
    rows = rows.withColumn("_base", F.floor("_p").cast("bigint")).withColumn("_part", F.col("_p") - F.floor("_p")).drop("_p")
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(7), "_draw"), F.lit(buckets)))
    open_ = (F.col("_part") > 0) & (F.col("_part") < 1)
    now = stored(_round(rows, ["_source", "_bucket"], buckets == 1), "mixing")
    done = now.where(~open_)
    while buckets > 1:
        buckets = -(-buckets // FAN)
        now = stored(_round(now.where(open_).withColumn("_bucket", F.floor(F.col("_bucket") / FAN).cast("bigint")), ["_source", "_bucket"], buckets == 1), "mixing")
        done = done.unionByName(now.where(~open_))
    copies = F.col("_base") + F.col("_part").cast("bigint")
    return done.select(*(F.col(f"`{c}`") for c in rest), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.coalesce("_target", F.lit(0.0)).alias("target"), copies.alias("copies"), (copies * F.col("_size")).alias("taken"))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """docs with each row as many times as the mix takes it; a document without words stays only if its draw says so.

    Sizes, ids and a hash of each row are rounded; texts only meet the numbers of copies, in one keyed join. Rows that are equal in all columns are taken
    as often as all of them together.
    """
    on = {"_mix_id": F.col(f"`{id_col}`"), "_mix_source": F.col(f"`{source}`"), "_mix_size": word_count(text), "_mix_row": F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))}
    keyed = docs.withColumns(on)
    each = keyed.groupBy(*on).agg(F.count("*").alias("_mix_n")).withColumn("_mix_nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix_n"))))
    found = mixed(each, "_mix_id", text, "_mix_source", keep=True, words=F.col("_mix_size"), **settings)
    taken = found.groupBy(*on).agg(F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_n")).where("_mix_copies > 0")
    taken = stored(taken.select(*(F.col(c).alias(f"{c}_") for c in on), "_mix_copies", "_mix_n"), "mixing-taken")
    same = (keyed["_mix_row"] == taken["_mix_row_"]) & (keyed["_mix_size"] == taken["_mix_size_"]) & keyed["_mix_id"].eqNullSafe(taken["_mix_id_"]) & keyed["_mix_source"].eqNullSafe(taken["_mix_source_"])
    rows = keyed.join(taken, same)
    # of equal rows one stands for all; there are none in most tables, and then nothing more is shuffled
    if not taken.where("_mix_n > 1").isEmpty():
        rows = rows.where("_mix_n = 1").unionByName(rows.where("_mix_n > 1").dropDuplicates([*on]))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix_copies")))).select(*(F.col(f"`{c}`") for c in docs.columns))
