"""Tables in the cluster's shared folder: results that are read twice, and running counts over a global order."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where it is unset (tests, one machine), a folder made once per session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="maskline-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def filesystem(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the session's process ends."""
    path = f"{shared_dir(spark)}/maskline-{name}-{uuid.uuid4().hex[:12]}"
    system, target = filesystem(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once and read from its files: later plans neither compute it again nor depend on lost executors."""
    path = f"{new_folder(df.sparkSession, name)}/t"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running(rows: DataFrame, order: list[str], n: str, name: str = "running", save: Callable[[DataFrame, str], DataFrame] = saved) -> DataFrame:
    """rows, saved (by save), with before: the sum of n over all rows that come earlier in order.

    Rows are range-partitioned once and saved as they lie; each partition sums up its own rows, and one total per partition is
    added up over partitions. No task sees more than one range.
    """
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    numbered = save(numbered, name).withColumn("_part", F.shiftright("_mid", 33))
    totals = numbered.groupBy("_part").agg(F.sum(n).alias("_total"))
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    own = F.coalesce(F.sum(n).over(W.partitionBy("_part").orderBy("_mid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = numbered.withColumn("before", own).join(F.broadcast(offsets), "_part")  # one row per partition
    return placed.withColumn("before", (F.col("before") + F.col("_offset")).cast("long")).drop("_part", "_mid", "_offset")
