"""Streams of logs and events as incremental tables.

A file source takes whole new files, so a log is rotated into files rather than followed by
bytes: no line is cut at a poll's edge, and none is lost at a rotation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.sources.readers import training_progress


def log_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Non-empty lines of files as they arrive, without their paths' secrets to care for."""
    return spark.readStream.text(directory).select(F.col("value").alias("line")).where("line <> ''")


def progress_stream(lines: DataFrame) -> DataFrame:
    """Progress reports of a stream of log lines."""
    return lines.select(training_progress(F.col("line")).alias("p")).where("p is not null").select("p.*")


def running_best(progress: DataFrame) -> DataFrame:
    """The best error so far and its iteration: one row of state."""
    return progress.agg(F.min("bcer").alias("best"), F.min_by("iter", F.struct("bcer", "iter")).alias("best_iter"), F.max("iter").alias("last_iter"))


def drained(stream: DataFrame, directory: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all that is there, and returns what it came to as a table.

    Every micro-batch is written to the shared folder; in complete mode the last one counts.
    """
    spark = stream.sparkSession
    name = uuid.uuid4().hex
    out, marks = f"{directory}/stream-{name}", f"{directory}/stream-{name}-marks"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    stream.writeStream.outputMode(mode).option("checkpointLocation", marks).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The events of a Parquet table as a stream; a table of a single file is found in its folder.

    Event times without a zone are taken in the session's, since watermarks need instants.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        stream = reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())
    else:
        stream = reader.parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def counts_by(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window of event time; rows later than ``late`` are let go by the watermark."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
