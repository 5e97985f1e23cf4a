"""Helpers that several operators share: lineage cuts and split ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import work_path
from ..sources.tables import read_table

__all__ = ["cut", "documents", "grouped_rank", "read_table", "row_key", "shuffle_width",
           "small_batches", "tie_range"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return read_table(spark, sf_dir, "documents")


#: Bytes of an Arrow batch, at most (one longer row makes a longer batch).
BATCH = 1 << 22


def small_batches(spark: SparkSession) -> None:
    """Limit Arrow batches to ``BATCH`` bytes on this session, unless it sets a limit of its own.

    With texts a batch of the default 10,000 rows takes tens of MB, several
    times over: outside the executor's heap and in its Python workers.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's own default
        spark.conf.set(name, str(BATCH))


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder (with the writer's ``options``) and read it back.

    The result's lineage starts at files every executor can read, so a lost
    executor costs the tasks it was running, never the steps before.
    """
    small_batches(df.sparkSession)
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*cols: Column) -> Column:
    """64-bit identity of a row's content; nulls count as a value of their own.

    ``xxhash64`` skips nulls, so each column adds its null flag.
    """
    return F.xxhash64(*[x for c in cols for x in (c, c.isNull())])


def tie_range(tie: Column | str, split: int = 64) -> Column:
    """The range of ``grouped_rank`` that a tie value lies in: ranks follow (range, tie)."""
    return F.pmod(F.shiftrightunsigned(tie, 32), F.lit(split))


def grouped_rank(df: DataFrame, keys: list[str], tie: str, out: str,
                 split: int = 64) -> DataFrame:
    """0-based rank of each row within ``keys`` (not null), in the order of the long ``tie``.

    No group meets in one task: a group is cut into ``split`` ranges of the
    tie value, rows are numbered within a range, and the ranges' row counts
    (at most ``split`` per group) give each range its first number.  Rows
    with equal tie values are numbered in any order.
    """
    part = f"{out}__range"
    df = df.withColumn(part, tie_range(tie, split))
    at = [*keys, part]
    counts = df.groupBy(*at).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(*at, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = W.partitionBy(*at).orderBy(tie)
    return (df.withColumn("__k", F.row_number().over(within))
            .join(first, at)
            .withColumn(out, (F.col("__first") + F.col("__k") - 1).cast("long"))
            .drop(part, "__k", "__first"))
