"""Event streams: the category summary per time window and the roll-up per visit session.

Extensions of the batch operators of the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import shared_path


def event_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table below a folder, a file or a folder of part files, as a stream with zoned event time."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory():
        stream = spark.readStream.schema(schema).parquet(path)
    else:
        stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_summary(events: DataFrame, window: str, delay: str) -> DataFrame:
    """Rows and mean value per tumbling window and event type."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", window), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n", "mean")
    )


def session_summary(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """Rows and total value per user session closed by a gap."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select("user_id", F.col("session_window.start").alias("session_start"), "n", "total")
    )


#: Event time of the row that ends a stream, behind any real one.
END = "9999-12-30 00:00:00"


def run_closed(events: DataFrame, summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Process what is there in append mode, close what is still open, and read the result.

    The stateful operators of ``summary`` hand on a window or session when the watermark has
    passed it and then drop it from their state, so the state holds the open ones only. When all is
    read, a single row of event time END arrives on a second source: the watermark passes every
    window, and the same query, restarted from its checkpoint, hands on the rest. Rows
    in the batches of one run may come in any order; a row that is later than the delay behind
    an earlier batch is dropped, as the watermark says.

    A batch writes a folder of its own number and overwrites it when it is repeated, so a batch
    that fails half-way counts once, and nothing about finished batches is kept on the driver.
    """
    spark = events.sparkSession
    base = shared_path(spark, "stream")
    schema, marks = events.schema, f"{base}/end"
    spark.createDataFrame([], schema).write.parquet(marks)
    result = summary(events.unionByName(spark.readStream.schema(schema).parquet(marks)))

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/rows/{batch:012d}")

    def run() -> None:
        stream = result.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", f"{base}/state")
        stream.trigger(availableNow=True).start().awaitTermination()

    run()
    end = [F.lit(END if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).coalesce(1).select(*end).write.mode("append").parquet(marks)
    run()
    return spark.read.schema(result.schema).parquet(f"{base}/rows/*")
