"""Tables written once on the way to a result, in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in ``spark.checkpoint.dir``; only where that is unset, as in tests on one machine, under ``/tmp/checkpoints``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def parts_for(table: DataFrame, factor: int = 16) -> int:
    """Tasks in proportion to the splits of an input table, of which Spark bounds the size.

    Where rows are dealt over a given number of tasks, Spark doesn't put shuffled parts together again. It does so by
    their compressed bytes, and sorted keys of many rows take few of these but much memory.
    """
    return max(8, factor * table.rdd.getNumPartitions())


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once and read again: lineage is cut, numbers that depend on the plan stay as they are."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out
