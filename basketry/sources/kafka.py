"""Kafka source and sink options.

The Kafka connector jar is not bundled; these functions build the reader /
writer with the options the jobs need and are unit-tested for their
options.  Submit with ``--packages org.apache.spark:spark-sql-kafka-0-10_2.13``
on a cluster.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic, consumer groups and defaults of the event jobs.
TOPIC = "financial_transactions"
EVENTS_GROUP = "basketry-events"
TRANSACTIONS_GROUP = "basketry-transactions"
DEFAULT_BOOTSTRAP = "localhost:9092"


def start_position(mode: str | None, timestamp_ms: str | int | None = None) -> dict[str, str]:
    """Start-position options for a Kafka reader.

    ``earliest`` / ``latest`` (default) / ``timestamp`` with epoch ms.  The
    mode is lower-cased; unknown modes and an unparsable or non-positive
    timestamp fall back to latest.
    """
    m = (mode or "latest").lower()
    if m == "earliest":
        return {"startingOffsets": "earliest"}
    if m == "timestamp":
        try:
            ts = int(str(timestamp_ms).strip())
        except (TypeError, ValueError):
            ts = 0
        if ts > 0:
            return {"startingTimestamp": str(ts),
                    "startingOffsetsByTimestampStrategy": "latest"}
    return {"startingOffsets": "latest"}


def kafka_options(bootstrap: str | None = None, topic: str = TOPIC, group: str = EVENTS_GROUP,
                  start_mode: str | None = "latest",
                  start_timestamp_ms: str | int | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options.  Several queries of a job read the topic at once, so
    they share a group *prefix* only: Spark makes a group of its own for each
    (one ``kafka.group.id`` for all would split the records between them).
    ``max_offsets_per_trigger`` bounds a micro-batch, e.g. of a first start
    from the earliest offsets.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap or DEFAULT_BOOTSTRAP,
        "subscribe": topic,
        "groupIdPrefix": group,
        # Offsets live in the query checkpoint; a lost broker partition must
        # not stop the job silently.
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update(start_position(start_mode, start_timestamp_ms))
    return opts


def transaction_kafka_options(bootstrap: str | None = None, topic: str = TOPIC,
                              max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """The transaction job always starts from the earliest offsets."""
    return kafka_options(bootstrap, topic, TRANSACTIONS_GROUP, "earliest",
                         max_offsets_per_trigger=max_offsets_per_trigger)


def range_options(start: int | dict[int, int], end: int | dict[int, int] | None = None,
                  bootstrap: str | None = None, topic: str = TOPIC) -> dict[str, str]:
    """Reader options of a bounded read, for back-fills.

    ``start`` and ``end`` are epoch milliseconds (from start on, before end;
    a time behind the last record is the topic's end) or offsets per
    partition (``-2`` earliest, ``-1`` latest), both of one kind.  Without
    ``end`` the read goes up to the records there are when it starts.
    """
    if end is not None and isinstance(start, dict) != isinstance(end, dict):
        raise ValueError("start and end have to be both times or both offsets")
    opts = {"kafka.bootstrap.servers": bootstrap or DEFAULT_BOOTSTRAP, "subscribe": topic,
            "failOnDataLoss": "true"}
    if isinstance(start, dict):
        if end is not None and set(start) != set(end):
            raise ValueError("start and end have to name the same partitions")
        offsets = lambda o: json.dumps({topic: {str(p): int(n) for p, n in sorted(o.items())}})
        opts["startingOffsets"] = offsets(start)
        opts["endingOffsets"] = offsets(end) if end is not None else "latest"
    else:
        if end is not None and end < start:
            raise ValueError("end lies before start")
        opts["startingTimestamp"] = str(int(start))
        opts["startingOffsetsByTimestampStrategy"] = "latest"
        if end is not None:
            opts["endingTimestamp"] = str(int(end))
        else:
            opts["endingOffsets"] = "latest"
    return opts


def _records(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("record_ts"),
                     F.struct("offset", "partition").alias("arrival"))


def read_kafka_range(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Batch: the records between two bounds (``range_options``), in the stream's columns."""
    reader = spark.read.format("kafka")
    for k, v in options.items():
        reader = reader.option(k, v)
    return _records(reader.load())


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka records as ``(value, record_ts, arrival)``; the key is unused on read.

    ``arrival`` orders the records: offset, then partition.  The record time
    takes no part in it: a producer may set it, also backwards.
    """
    reader = spark.readStream.format("kafka")
    for k, v in options.items():
        reader = reader.option(k, v)
    return _records(reader.load())


def write_kafka_options(bootstrap: str | None = None, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap or DEFAULT_BOOTSTRAP, "topic": topic}
