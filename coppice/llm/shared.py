"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors see.

    It lies in the folder that the cluster names in ``spark.checkpoint.dir``. Only where that is unset, as in
    tests on one machine, a folder under ``/tmp/checkpoints`` takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage is cut and later readers don't recompute it."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark cuts Arrow batches by rows only unless told otherwise; texts differ in length by five orders of magnitude.
BATCH_BYTES = 8 << 20


def numbered(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` as text without nulls under the fixed name ``text``, in Arrow batches of bounded size.

    The bound is a setting of the session that plans read when they run, so it stays set.
    """
    from pyspark.sql import functions as F

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(df.sparkSession.conf.get(name).rstrip("b"))
    if now <= 0 or now > BATCH_BYTES:
        df.sparkSession.conf.set(name, BATCH_BYTES)
    return df.withColumn("text", F.coalesce(F.col(column).cast("string"), F.lit("")))
