"""File sources carrying the same wire records as Kafka.

A JSON-lines file has one record per line — exactly a Kafka ``value``.  The
record time (used when the event's own timestamp cannot be parsed) is the
file's modification time, Spark's ``_metadata.file_modification_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _records(df: DataFrame) -> DataFrame:
    """``arrival`` orders the records: time of the file, file, then place of its
    block (the lines of a block stay in order)."""
    meta = F.col("_metadata")
    return df.select(F.col("value"), meta["file_modification_time"].alias("record_ts"),
                     F.struct(meta["file_modification_time"].alias("time"), meta["file_path"].alias("file"),
                              meta["file_block_start"].alias("block")).alias("arrival"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Batch: JSON-lines files as ``(value, record_ts, arrival)``."""
    return _records(spark.read.text(path))


def read_records_stream(spark: SparkSession, path: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream: new JSON-lines files as ``(value, record_ts, arrival)``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _records(r.load(path))
