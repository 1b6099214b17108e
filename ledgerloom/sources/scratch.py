"""Intermediate tables, written where all executors can read them.

They lie below ``spark.checkpoint.dir``; a local session without it gets a temporary folder.
Written rows cut the lineage and survive a lost executor.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; one of our own only where the session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a written table; nothing happens where the session has ended."""
    jvm = spark.sparkContext._jvm
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of ended jobs now; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _end(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session has ended before the process
        return


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table of its own, which lives until the Python process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    atexit.register(_end, spark, path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """As ``written``; the shuffles that made the table are gone when it is there."""
    out = written(df)
    release(df.sparkSession)
    return out
