"""Replay-safe result writers, used from ``foreachBatch``.

* ``BucketTable`` — keyed table with one row per key, in bucket folders.  A
  batch rewrites the buckets it touches: the merged rows are staged, then the
  folders are replaced, so a crash at any point is mended by the re-run.
  Reads scan one row per key; there is no log to fold.
* ``BatchLog`` — rows that are emitted once (append mode), in a folder per
  batch, with a count beside each: re-running a batch replaces both, and a
  total is the sum of one small row per batch.
* ``LatestSlot`` — the newest value of a metric, one row, guarded by its event
  time.
* ``ReplaceByKey`` — a batch replaces every partition (e.g. one hour) it
  writes: the "delete the key, then add its members" semantic of a sorted
  set, without leftovers when a member drops out on replay.
* ``jdbc_upsert`` — set-based upsert into a database: bulk write to a
  staging table, then one ``MERGE`` statement per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_parquet_or_empty(spark: SparkSession, path: str,
                          schema: T.StructType | str | None) -> DataFrame | None:
    """Read a result folder; an absent folder, or one that only empty
    micro-batches have touched, reads as an empty frame of ``schema``."""
    if path_exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    if schema is None:
        return None
    return spark.createDataFrame([], schema)


def _dynamic_overwrite(df: DataFrame, path: str, partition_col: str) -> None:
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _rename(spark: SparkSession, path: str, to: str) -> bool:
    p, q = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (path, to))
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).rename(p, q)


class BucketTable:
    """Keyed table: the newest row of each key, stored by bucket.

    ``bucket`` (optional) makes the bucket number, a function of the key such
    as its month, for tables whose batches touch few of them; otherwise it is
    a hash of the key in ``buckets`` folders.  Each stored row carries the
    batch that wrote it.  ``hidden`` columns are stored for later batches and
    left out of ``read``.
    """

    def __init__(self, path: str, keys: list[str], schema: T.StructType | str, buckets: int = 16,
                 bucket=None, hidden: tuple[str, ...] = ()):
        self.path, self.keys, self.buckets, self.hidden = path, keys, buckets, tuple(hidden)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.columns = self.schema.names
        self.stored = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()),
                                    T.StructField("bucket", T.IntegerType())])
        self._bucket = bucket
        self._touched: tuple[int, list[int]] = (-1, [])

    def bucket(self):
        if self._bucket is not None:
            return self._bucket().cast("int")
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def stage(self, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}_stage/batch_id={int(batch_id)}"

    def _rows(self, spark: SparkSession, path: str | None = None) -> DataFrame:
        return spark.read.schema(self.stored).parquet(path or self.path)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows by bucket, for one file each; hash buckets have a partition each, so that a
        task's rows do not depend on the stream's number of partitions."""
        return rows.repartition("bucket") if self._bucket is not None else rows.repartition(self.buckets, "bucket")

    def write_batch(self, df: DataFrame, batch_id: int, order: list[str] | None = None) -> None:
        """Upsert a batch of one row per key, or of several where ``order`` names the columns
        whose descending order puts a key's last write first.

        With ``order`` the batch is read twice, the first time only for its
        buckets: its rows then meet each other and the old ones in one shuffle.

        A stage that is complete (its ``_SUCCESS`` marker is written last)
        belongs to an attempt that may have replaced some folders already: it
        is applied again as it is, never merged anew.
        """
        spark, stage = df.sparkSession, self.stage(batch_id)
        if not path_exists(spark, f"{stage}/_SUCCESS"):
            place = [F.col(c).alias(f"_o{k}") for k, c in enumerate(order or [])]
            new = (df.select(*self.columns, *place).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
                     .withColumn("bucket", self.bucket()))
            if not order:
                new = new.persist()
            try:
                touched = [r[0] for r in new.select("bucket").distinct().collect()]   # bucket numbers
                self._touched = (int(batch_id), touched)
                if not touched:
                    return
                rows, first = new, [F.desc(f"_o{k}") for k in range(len(place))]
                if path_exists(spark, self.path):
                    # old and new rows meet by bucket, in the one shuffle that also makes the files
                    old = self._rows(spark).where(F.col("bucket").isin(touched))
                    rows = (new.withColumn("_new", F.lit(1))
                            .unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True))
                    first = [F.desc("_new"), *first]
                rows = self._dealt(rows)
                if first:
                    newest = Window.partitionBy("bucket", *self.keys).orderBy(*first)
                    rows = rows.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1)
                (rows.select(*self.stored.names)
                     .write.mode("overwrite").partitionBy("bucket").option("compression", "zstd")
                     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(stage))
            finally:
                if not order:
                    new.unpersist()
        staged = self._rows(spark, stage)
        self._touched = (int(batch_id), [r[0] for r in staged.select("bucket").distinct().collect()])
        # a first batch has nothing to replace: its stage becomes the table
        if not path_exists(spark, self.path) and _rename(spark, stage, self.path):
            return
        # a staged file has rows of one bucket, so a copy of the files needs no shuffle
        _dynamic_overwrite(staged, self.path, "bucket")
        _delete(spark, stage)

    def touched(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Stored rows (with ``batch_id``) of the buckets that this batch has just rewritten."""
        last, buckets = self._touched
        if last != int(batch_id) or not buckets:
            return None
        return self._rows(spark).where(F.col("bucket").isin(buckets))

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per key."""
        cols = [c for c in self.columns if c not in self.hidden]
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self.schema).select(*cols)
        return self._rows(spark).select(*cols)


class BatchLog:
    """Rows that are final when emitted, in a folder per batch, and their counts.

    A re-run batch replaces its folder and its count, so neither a row nor the
    total is ever counted twice.
    """

    def __init__(self, path: str, schema: T.StructType | str):
        self.path = path
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.counts = path.rstrip("/") + "_counts"

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        spark, b = df.sparkSession, F.lit(int(batch_id)).cast("bigint")
        _dynamic_overwrite(df.withColumn("batch_id", b), self.path, "batch_id")
        # from the footers of the files just written
        n = self._rows(spark).where(F.col("batch_id") == b).count()
        if n:
            _dynamic_overwrite(spark.range(1).select(F.lit(n).cast("bigint").alias("n"), b.alias("batch_id")),
                               self.counts, "batch_id")

    def _rows(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], self.schema).withColumn("batch_id", F.lit(0).cast("bigint"))
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(
            self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).select(*self.schema.names)

    def count(self, spark: SparkSession) -> DataFrame:
        """``n``, the number of rows: one small row per batch is read, not the rows."""
        if path_exists(spark, self.counts):
            per_batch = spark.read.schema("n bigint, batch_id bigint").parquet(self.counts)
        else:
            per_batch = spark.createDataFrame([], "n bigint")
        return per_batch.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))


class LatestSlot:
    """The newest value of one metric: a single row (ts, value), replaced by newer event times only."""

    SCHEMA = "ts timestamp, value bigint, batch_id bigint, metric string"

    def __init__(self, path: str, metric: str):
        self.path, self.metric = path, metric

    def write_batch(self, df: DataFrame, ts: str, value: str, batch_id: int) -> None:
        """The newest row of a batch goes in unless the slot is newer, so a replay of an older batch can't win."""
        spark = df.sparkSession
        new = df.agg(F.max(F.struct(F.unix_micros(ts).alias("us"), F.col(value).alias("v"))).alias("m")).first()["m"]
        if new is None:
            return
        now = self.read(spark).select(F.unix_micros("ts").alias("us")).first()
        if now is not None and now["us"] > new["us"]:
            return
        row = spark.range(1).select(F.timestamp_micros(F.lit(new["us"])).alias("ts"),
                                    F.lit(new["v"]).cast("bigint").alias("value"),
                                    F.lit(int(batch_id)).cast("bigint").alias("batch_id"),
                                    F.lit(self.metric).alias("metric"))
        _dynamic_overwrite(row, self.path, "metric")

    def read(self, spark: SparkSession) -> DataFrame:
        """(ts, value): one row, or none before the first batch."""
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], "ts timestamp, value bigint")
        rows = spark.read.schema(self.SCHEMA).parquet(self.path)
        return rows.where(F.col("metric") == self.metric).select("ts", "value")


class ReplaceByKey:
    """Each batch replaces the partitions (key values) it contains."""

    def __init__(self, path: str, key: str, schema: T.StructType | None = None):
        self.path = path
        self.key = key
        self.schema = schema

    def write_batch(self, df: DataFrame, batch_id: int | None = None) -> None:
        # one file per key value (e.g. per hour), not one per task and key
        _dynamic_overwrite(df.repartition(self.key), self.path, self.key)

    def read(self, spark: SparkSession, key_value: str | None = None) -> DataFrame:
        if self.schema is not None and path_exists(spark, self.path):
            try:   # the declared schema keeps the key's type (no partition type guess)
                df = spark.read.schema(self.schema).parquet(self.path)
            except AnalysisException:
                df = spark.createDataFrame([], self.schema)
        else:
            df = read_parquet_or_empty(spark, self.path, self.schema)
        if df is None:
            raise FileNotFoundError(self.path)
        return df.filter(F.col(self.key) == key_value) if key_value is not None else df


def _q(name: str) -> str:
    """Quoted identifier: Spark's JDBC writer creates quoted lower-case columns."""
    return '"' + name.replace('"', '""') + '"'


def merge_sql(table: str, staging: str, keys: list[str], columns: list[str],
              casts: dict[str, str] | None = None) -> str:
    """ANSI MERGE from a staging table: insert new keys, overwrite the rest.
    ``casts`` gives SQL types to cast staging columns to."""
    casts = casts or {}

    def src(c):
        return f"CAST(s.{_q(c)} AS {casts[c]})" if c in casts else f"s.{_q(c)}"

    on = " AND ".join(f"t.{_q(k)} = {src(k)}" for k in keys)
    non_keys = [c for c in columns if c not in keys]
    upd = ", ".join(f"{_q(c)} = {src(c)}" for c in non_keys)
    ins_cols = ", ".join(_q(c) for c in columns)
    ins_vals = ", ".join(src(c) for c in columns)
    sql = f"MERGE INTO {table} t USING {staging} s ON {on} "
    if upd:
        sql += f"WHEN MATCHED THEN UPDATE SET {upd} "
    return sql + f"WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})"


def postgres_upsert_sql(table: str, staging: str, keys: list[str], columns: list[str]) -> str:
    non_keys = [c for c in columns if c not in keys]
    cols = ", ".join(_q(c) for c in columns)
    upd = ", ".join(f"{_q(c)} = EXCLUDED.{_q(c)}" for c in non_keys)
    action = f"DO UPDATE SET {upd}" if upd else "DO NOTHING"
    return (f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging} "
            f"ON CONFLICT ({', '.join(_q(k) for k in keys)}) {action}")


def replace_sql(table: str, staging: str, replace_key: str, columns: list[str]) -> list[str]:
    """Replace whole key groups (e.g. hours): delete the staged keys, insert."""
    cols = ", ".join(_q(c) for c in columns)
    return [f"DELETE FROM {table} WHERE {_q(replace_key)} IN "
            f"(SELECT {_q(replace_key)} FROM {staging})",
            f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging}"]


def _execute(spark: SparkSession, url: str, statements: list[str], props: dict,
             ignore_errors: bool = False, transaction: bool = False) -> None:
    jvm = spark._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k != "driver":
            jprops.setProperty(k, str(v))
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        if transaction:
            conn.setAutoCommit(False)
        st = conn.createStatement()
        try:
            for s in statements:
                try:
                    st.execute(s)
                except Exception:
                    if not ignore_errors:
                        raise
            if transaction:
                conn.commit()
        except Exception:
            if transaction:
                conn.rollback()
            raise
        finally:
            st.close()
    finally:
        conn.close()


def jdbc_upsert(df: DataFrame, batch_id: int, url: str, table: str, keys: list[str],
                props: dict | None = None, dialect: str = "merge",
                batch_size: int = 1000, replace_key: str | None = None,
                max_connections: int = 8) -> None:
    """Upsert one micro-batch: bulk-load a staging table, then one statement.

    The batch must hold one row per key (dedupe before calling).  Replaying
    a batch id re-applies the same values, so the result is unchanged.
    ``replace_key``: instead of upserting rows, replace every group of that
    key present in the batch (delete + insert in one transaction).
    ``max_connections`` caps the concurrent inserts into the staging table
    (Spark coalesces the write to that many partitions), so a large cluster
    does not open one database connection per task.
    """
    props = dict(props or {})
    spark = df.sparkSession
    staging = f"{table}_stage_{int(batch_id)}"
    # overwrite: a leftover of a crashed attempt of the same batch is replaced
    (df.write.mode("overwrite").option("batchsize", str(batch_size))
       .option("numPartitions", str(max_connections))
       .jdbc(url, staging, properties=props))
    if replace_key:
        stmts = replace_sql(table, staging, replace_key, df.columns)
    elif dialect == "merge":
        # Spark stages strings as CLOB on Derby, which cannot be compared
        # with VARCHAR keys: cast them in the statement there.
        casts = {f.name: "VARCHAR(32672)" for f in df.schema.fields
                 if url.startswith("jdbc:derby:") and isinstance(f.dataType, T.StringType)}
        stmts = [merge_sql(table, staging, keys, df.columns, casts)]
    else:
        stmts = [postgres_upsert_sql(table, staging, keys, df.columns)]
    _execute(spark, url, stmts, props, transaction=True)
    _execute(spark, url, [f"DROP TABLE {staging}"], props)


def jdbc_execute(spark: SparkSession, url: str, statements: list[str],
                 props: dict | None = None) -> None:
    """Run DDL (e.g. ``schemas.DDL``) once at job start."""
    _execute(spark, url, statements, dict(props or {}))


class JdbcTable:
    """Keyed upsert into a database table from ``foreachBatch``.

    A batch upsert is idempotent (staging overwrite + one MERGE), so a
    failed attempt is simply retried, up to ``max_retries`` times with a
    growing pause, before the micro-batch (and the query) fails.
    """

    def __init__(self, url: str, table: str, keys: list[str], props: dict | None = None,
                 dialect: str = "postgres", batch_size: int = 500, max_retries: int = 5,
                 backoff_s: float = 0.5, replace_key: str | None = None):
        self.url, self.table, self.keys, self.replace_key = url, table, keys, replace_key
        self.props, self.dialect, self.batch_size = dict(props or {}), dialect, batch_size
        self.max_retries, self.backoff_s = max_retries, backoff_s

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        import time
        for attempt in range(self.max_retries + 1):
            try:
                jdbc_upsert(df, batch_id, self.url, self.table, self.keys, self.props,
                            self.dialect, self.batch_size, self.replace_key)
                return
            except Exception:
                if attempt == self.max_retries:
                    raise
                time.sleep(self.backoff_s * (2 ** attempt))


class SearchIndex:
    """Search documents (index, id, doc) written with a configurable connector.

    ``fmt`` and ``options`` are the deployment's (e.g. a search engine's Spark
    connector with the id column mapped to the document id, so a replayed
    batch overwrites its documents); ``to_docs`` shapes the rows.
    """

    def __init__(self, to_docs, fmt: str, options: dict | None = None, mode: str = "append"):
        self.to_docs, self.fmt, self.options, self.mode = to_docs, fmt, dict(options or {}), mode

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        docs = self.to_docs(df)
        docs.write.format(self.fmt).mode(self.mode).options(**self.options).save()


class Fanout:
    """Write one micro-batch to several sinks, computing it once.

    The batch is persisted for the duration of the call (the stateful plan
    is not re-run per sink) and released afterwards.  ``shape`` maps a sink
    index to a projection applied before that sink (e.g. drop a column the
    database table does not have).
    """

    def __init__(self, *writers, shapes: dict | None = None):
        self.writers = writers
        self.shapes = shapes or {}

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            for i, w in enumerate(self.writers):
                shaped = self.shapes[i](df) if i in self.shapes else df
                w.write_batch(shaped, batch_id)
        finally:
            df.unpersist()
