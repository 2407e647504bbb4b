"""Helpers shared by the corpus operators: tables, the shared folder, word splitting."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step inside a task works on at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a local session without one a folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='roadweave-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: later uses don't run its plan again, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files behind a table that `stored` wrote and nothing will read again."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of a bitmap, at most: 532,610 rows when it is broadcast.
MOST_BITS = 1 << 25


def maybe_in(df: DataFrame, column: str, table: DataFrame, out: str = "maybe") -> DataFrame:
    """df with `out`: false if table's column of that name surely lacks the row's value. JVM only, and no shuffle of df.

    The values' hashes are marked in a bitmap of 16 bits a value, MOST_BITS at most, which is broadcast: with very many values it
    tells less and less, but is never wrong.
    """
    bits = min(MOST_BITS, 1 << max(10, (16 * table.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    word, bit = F.floor(place / 63).cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 63).cast("int"))
    bitmap = table.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    return df.withColumn("_word", word).join(F.broadcast(bitmap), "_word", "left").withColumn(out, F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_word", "_bits")


def per_process(key, make):
    """What `make` returns, made once in a Python worker: Spark gives a worker many tasks in turn."""
    held = sys.__dict__.setdefault("_roadweave_held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def give_back() -> None:
    """Returns freed memory to the system: the Python worker lives on, idle, beside others."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run):
    """run, a function of Arrow batches, giving memory back when it ends."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about `limit` bytes; a longer text comes alone, whole."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start, before = 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Row number and text of each word `[^\\x20\\x09-\\x0D]+` of each text, in order; null has none. lower: A-Z become a-z, nothing else."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    rows, flat = pc.list_parent_indices(lists), lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    return rows.filter(full).to_numpy(zero_copy_only=False).astype(np.int64), flat.filter(full)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
