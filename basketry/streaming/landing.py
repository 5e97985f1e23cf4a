"""Decode a topic once: the landing table that all metric streams read.

One stream reads the source, decodes each record once and writes it as typed
Parquet with Spark's file sink.  The sink's log makes every micro-batch appear exactly once, also
when it is re-run after a crash, and a stream that reads the folder follows
that log.  Metric streams therefore scan only the columns they use, never the
JSON, and dead letters are the other kind of the same write.

Rows keep their event time, so a reader's watermark follows all good events,
as it did on the source.  Events lie in folders by kind and event day.  A
topic whose order of arrival counts is ``ordered``: its files are not split by
any column, so a task's rows stay in the order in which it read them, and
``seq``, the row's place in its file, continues the order of ``arrival``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

GOOD, DEAD = "good", "dead"
#: Columns of the landing table beside the decoded ones.
SHELF = ["kind", "day"]


def shelved(decoded: DataFrame, day: Column) -> DataFrame:
    """Decoded rows (with value and reason) as the landing table stores them:
    the record's text stays with dead letters only."""
    good = F.col("reason").isNull()
    return (decoded.withColumn("value", F.when(~good, F.col("value")))
            .withColumn("kind", F.when(good, F.lit(GOOD)).otherwise(F.lit(DEAD)))
            .withColumn("day", F.when(good, F.to_date(day))))


class Landing:
    """The landing table of one topic at ``path``; ``schema`` is that of ``shelved`` rows."""

    def __init__(self, path: str, schema: T.StructType | str, ordered: bool = False):
        self.path, self.ordered = path, ordered
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        # partition columns are read back last
        inner = [f for f in schema.fields if f.name not in SHELF]
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in inner]
                                   + [T.StructField("kind", T.StringType()), T.StructField("day", T.DateType())])

    def start(self, rows: DataFrame, name: str, checkpoint: str, trigger: dict,
              retention: str | None = None) -> StreamingQuery:
        """Write ``shelved`` rows; ``retention`` drops older files from the sink's log."""
        w = (rows.writeStream.queryName(name).format("parquet").outputMode("append")
             .option("path", self.path).option("checkpointLocation", checkpoint))
        if not self.ordered:
            w = w.partitionBy(*SHELF)
        if retention:
            w = w.option("retention", retention)
        return w.trigger(**trigger).start()

    def _folder(self, spark: SparkSession) -> str:
        """The table's folder, made if the landing stream has not written yet."""
        p = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
        return self.path

    def stream(self, spark: SparkSession, max_files: int | None = None) -> DataFrame:
        """Good rows as a stream; ``max_files`` bounds a micro-batch."""
        r = spark.readStream.schema(self.schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", str(max_files))
        return self._good(r.parquet(self._folder(spark)))

    def read(self, spark: SparkSession) -> DataFrame:
        """Good rows landed so far (batch), for back-fills and reports by day."""
        return self._good(spark.read.schema(self.schema).parquet(self._folder(spark)))

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        """(value, reason) of the records that could not be decoded."""
        rows = spark.read.schema(self.schema).parquet(self._folder(spark))
        return rows.where(F.col("kind") == DEAD).select("value", "reason")

    def _good(self, rows: DataFrame) -> DataFrame:
        good = rows.where(F.col("kind") == GOOD)
        cols = [c for c in self.schema.names if c not in ("value", "reason", *SHELF)]
        place = [F.col("_metadata.row_index").alias("seq")] if self.ordered else []
        return good.select(*cols, *place)
