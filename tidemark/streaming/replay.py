"""Stored tables as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.timing import event_time


def stream_table(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream, without copying it.

    Uncapped, a bounded run takes all files that are there as one micro-batch, so
    its result does not depend on how many files there are or how they are listed.
    """
    path = path.rstrip("/")
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    found = stored.select("_metadata.file_name").head()
    if found and found[0] == path.rsplit("/", 1)[-1]:
        # The stream source takes a plain path for a folder.  A single file is
        # given as a pattern that matches only itself.
        path = f"{path[:-1]}{{{path[-1]}}}"
    return reader.parquet(path)


def stream_events(spark: SparkSession, path: str, ts: str = "ts",
                  per_trigger: int | None = None) -> DataFrame:
    """The same with its time column turned into event time."""
    return stream_table(spark, path, per_trigger).withColumn(ts, event_time(ts))


def land(df: DataFrame, path: str, *by: str) -> str:
    """Add rows to a landing folder, for a stream over it to pick up (runs a job).

    ``by`` names columns to lay the files out by.
    """
    df.write.mode("append").partitionBy(*by).parquet(path)
    return path
