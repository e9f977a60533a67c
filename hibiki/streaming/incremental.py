"""Structured Streaming: each file once, windowed counts, de-duplicated appends."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hibiki.session import checkpoint_dir
from hibiki.sources import readers


def _source(spark: SparkSession, path: str) -> DataFrame:
    """A file stream over a folder of Parquet files, or over one file's folder and name."""
    schema = spark.read.parquet(path).schema
    local = path.removeprefix("file://")
    reader = spark.readStream.schema(schema)
    if os.path.isfile(local):
        return reader.option("pathGlobFilter", os.path.basename(local)).parquet(os.path.dirname(path))
    return reader.parquet(path)


def run_once(stream: DataFrame, write: Callable[[DataFrame, int], None], name: str, mode: str = "append") -> None:
    """Process what is there and not yet processed, then stop. State is kept in the shared checkpoint folder."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoint_dir(stream.sparkSession)}/streams/{name}").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()


def daily_counts(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """day, event_type, n: counts in one-day windows of event time, read as a stream and written as a table.

    Time without zone must become a timestamp before a watermark can be set. Windows
    are updated: a batch writes those that it changed, under its number, so that a
    repeated batch replaces its own rows; the last count of a window is the one
    that holds. The watermark drops the state of days that are over.
    """
    events = _source(spark, path).withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counts = events.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    name = f"daily-{uuid.uuid4().hex}"
    out = f"{checkpoint_dir(spark)}/streams-out/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run_once(counts, write, name, "update")
    written = spark.read.schema("day string, event_type string, n bigint, batch bigint").parquet(out)
    return written.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))


def ingest(spark: SparkSession, source: str, target: str, key: str, name: str) -> DataFrame:
    """Append the rows of files that weren't read yet and whose key isn't in the target; the target comes back.

    A batch that is repeated after a failure finds its own rows already there, so each row is appended once.
    """
    schema = spark.read.parquet(source).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        new = batch.dropDuplicates([key])
        if readers.exists(spark, target):
            new = new.join(spark.read.schema(schema).parquet(target).select(key), key, "left_anti")
        new.select(*schema.names).write.mode("append").parquet(target)

    run_once(_source(spark, source), write, name)
    return spark.read.schema(schema).parquet(target)


def appended_once(stream: DataFrame, key: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """The stream without repeats of a key inside the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
