"""Tables that a plan uses more than once, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to spark.checkpoint.dir and read back; a local session without that setting gets a folder of its own."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='roadweave-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
