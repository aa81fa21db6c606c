"""Windowed counts over an event stream. An extension: the engine's own operators are batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files of a folder as they land."""
    return spark.readStream.schema(schema).parquet(path)


def windowed(events: DataFrame, *, time_col: str = "ts", by: str = "event_type", value: str = "value", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event-time window; rows later than ``late`` behind the newest are left out of closed windows."""
    timed = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late)
    return timed.groupBy(F.window(time_col, window).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def append_missing(batch: DataFrame, sink: str, key: str) -> None:
    """A ``foreachBatch`` sink that writes what the sink doesn't have yet, so that a repeated batch adds nothing."""
    spark = batch.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
    if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        batch = batch.join(spark.read.parquet(sink).select(key), key, "left_anti")
    batch.dropDuplicates([key]).write.mode("append").parquet(sink)
