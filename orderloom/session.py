"""Session settings the plans rely on, and the shared working folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All of these may be changed on a running session.
RUNTIME_CONF = {
    # Wall-clock columns are timestamp_ntz; this keeps every other conversion on one zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where measured partitions are small enough to hash, no sort is needed for a join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # One key may hold a third of the rows: its shuffle partition is split at run time,
    # also where that costs the next operator a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Wide mart projections outgrow what HotSpot compiles; past its limit leave whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Python gets and keeps texts in pieces of bounded size, whatever their length.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Line tables carry no month, only their headers do.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings above to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process, as in a test, gets a temporary folder where none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="orderloom-")


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame below the shared folder and read it back: it is computed once and no longer reads what it was made from."""
    return stored(df, "cut")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a frame below the shared folder and read it back: lineage ends here, and lost executors cost no rerun."""
    path = working_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing that is yet to run reads it."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        drop_folder(df.sparkSession, folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are out of use.

    It does so when the driver collects them as garbage, which may be long after, and the disk of the next stage is needed before.
    Spark's listeners hold on to the query they heard of last, so a small one without a shuffle follows.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
