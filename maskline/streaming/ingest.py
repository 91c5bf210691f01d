"""Files as a stream: each micro-batch extends the vault once, so a batch that is run again adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vault


def batch_writer(spark: SparkSession, vault_path: str, *order: str):
    """A foreachBatch function: values (column, value, order...) that the vault lacks go to its folder batch=<id>, overwritten on a retry."""

    def write(batch: DataFrame, number: int) -> None:
        held = spark.read.schema("column string, value string, number long, batch long").parquet(vault_path).filter(F.col("batch") < number) if _exists(spark, vault_path) else spark.createDataFrame([], "column string, value string, number long, batch long")
        vault.extend(held.drop("batch"), batch, *order).write.mode("overwrite").parquet(f"{vault_path}/batch={number}")

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest(values: DataFrame, vault_path: str, checkpoint: str, *order: str):
    """Run all that is there and stop; finished files are known by the checkpoint."""
    query = values.writeStream.foreachBatch(batch_writer(values.sparkSession, vault_path, *order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def timeline(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Samples per window and type, late ones included up to the watermark."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.max("value").alias("peak")).select(F.col("w.start").alias("start"), "event_type", "n", "peak")
