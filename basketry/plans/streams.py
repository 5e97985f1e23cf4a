"""Streaming queries registered for the driver.

Each one writes the adapter's records as JSON lines (the Kafka value
format) into a folder under the shared checkpoint root, in three
event-time-ordered chunks.  After each chunk the streaming query runs with
``availableNow`` and stops; the next run restarts from its checkpoint —
so every result also went through a restart.  The result table is then
read back as a batch DataFrame.

Oracle: the batch query cut where the stream's watermark ends,
``max(event time of all decoded events) - 5 s``; roll-ups have no watermark
and equal the full batch result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import codec
from basketry.plans.oracle import ORACLE, sql
from basketry.plans.queries import _env, _tx, ntz
from basketry.session import work_path
from basketry.sources import files
from basketry.streaming import jobs
from basketry.streaming.writers import BatchLog

CHUNKS = 3
AVAILABLE_NOW = {"availableNow": True}


@contextmanager
def state_partitions(spark: SparkSession):
    """Run the harness's streams with one state partition per core.

    A checkpoint fixes a stream's state partitioning at its first start, to
    ``spark.sql.shuffle.partitions``; the default 200 makes every small
    micro-batch touch 200 state stores per stateful operator.  The harness
    sizes it to the cluster (``defaultParallelism``) and restores the
    session's setting afterwards.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        n = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: keep the session's setting
        n = int(before)
    spark.conf.set(key, str(max(1, n)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def feed_in_chunks(records: DataFrame, ts_col: str, in_dir: str, run, chunks: int = CHUNKS,
                   late: DataFrame | None = None, arrange=None, value=None) -> None:
    """Append ``value`` (a column made of those of ``records``; by default its
    column of that name) to ``in_dir`` in event-time order, running the
    stream after each chunk.  Only the time bounds come to the driver.
    ``late`` rows (a ``value`` column) arrive together with the last chunk;
    ``arrange`` puts a chunk's records into the order of their arrival.

    The records are computed once and held by columns; their texts are many
    times as large and are written once, compressed.
    """
    spark = records.sparkSession
    held = in_dir.rstrip("/") + "_held"
    records.write.option("compression", "zstd").parquet(held)
    source = spark.read.schema(records.schema).parquet(held)
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    value = F.col("value") if value is None else value
    # bounds as epoch microseconds, computed in Spark (no client time zone)
    lo_us, hi_us = source.agg(F.min(us), F.max(us)).first()
    if lo_us is None:
        with state_partitions(spark):
            run()
        return
    step = (hi_us - lo_us) // chunks + 1
    for i in range(chunks):
        first = lo_us + i * step
        part = source.filter((us >= F.lit(first)) & (us < F.lit(first + step)))
        if arrange is not None:
            part = arrange(part)
        part = part.select(value.alias("value"))
        if late is not None and i == chunks - 1:
            part = part.unionByName(late.select("value"))
        part.write.mode("append").option("compression", "gzip").text(in_dir)
        with state_partitions(spark):
            run()


def _event_stream_result(spark: SparkSession, sf_dir: str, name: str, start, read,
                         with_late: bool = False):
    out = jobs.Outputs(work_path(spark, name))
    in_dir = out.path("_input")
    env = _env(spark, sf_dir)
    late = None
    if with_late:
        # copies of the first day's page views, under new user ids, arriving
        # with the last chunk: far behind the watermark by then
        first_us = env.agg(F.min(F.unix_micros("event_ts"))).first()[0]
        early = env.filter(F.col("eventType") == "page_view") \
                   .filter(F.unix_micros("event_ts") < F.lit(first_us + 86_400_000_000))
        early = early.withColumn("userId", F.concat(F.lit("late-"), F.col("userId"))) \
                     .withColumn("eventId", F.concat(F.lit("late-"), F.col("eventId")))
        late = early.select(codec.encode_events(early).alias("value"))

    def run():
        raw = files.read_records_stream(spark, in_dir)
        _landing, table = jobs.land_events(raw, out, AVAILABLE_NOW)
        jobs.await_all([start(jobs.landed_events(table, spark), out, trigger=AVAILABLE_NOW)])

    feed_in_chunks(env, "event_ts", in_dir, run, late=late, value=codec.encode_events(env))
    return read(spark, out)


def stream_active_users(spark, sf_dir):
    return _event_stream_result(spark, sf_dir, "stream_active_users", jobs.start_active_users,
                                lambda s, o: ntz(o.active_users().read(s)))


def late_rows(spark, sf_dir):
    """B4: late copies of early page views are dropped; on-time rows kept."""
    return _event_stream_result(spark, sf_dir, "late_rows", jobs.start_active_users,
                                lambda s, o: ntz(o.active_users().read(s)), with_late=True)


def stream_top_products(spark, sf_dir):
    return _event_stream_result(
        spark, sf_dir, "stream_top_products", jobs.start_top_products,
        lambda s, o: ntz(o.top_products().read(s).select("hour_ts", "product_id", "amount",
                                                         "product_rank")))


def stream_abandoned_carts(spark, sf_dir):
    return _event_stream_result(spark, sf_dir, "stream_abandoned_carts",
                                jobs.start_abandoned_carts,
                                lambda s, o: ntz(o.abandoned().read(s)))


def stream_abandoned_cart_timers(spark, sf_dir):
    """E3/E4: the event-time timer machine, emission once the watermark passes add + T."""
    return _event_stream_result(
        spark, sf_dir, "stream_abandoned_cart_timers", jobs.start_abandoned_carts_event_time,
        lambda s, o: ntz(BatchLog(o.path("abandoned_carts_et"), "cart_id string, abandoned_at timestamp").read(s)))


def stream_sales_rollups(spark, sf_dir):
    out = jobs.Outputs(work_path(spark, "stream_sales_rollups"))
    in_dir = out.path("_input")
    tx = _tx(spark, sf_dir)

    def run():
        raw = files.read_records_stream(spark, in_dir)
        _landing, table = jobs.land_transactions(raw, out, AVAILABLE_NOW)
        jobs.await_all([jobs.start_sales_rollups(table.stream(spark), out, trigger=AVAILABLE_NOW)])

    feed_in_chunks(tx, "transaction_date", in_dir, run, value=codec.encode_transactions(tx, "millis"))
    cat = out.sales("sales_per_category").read(spark)
    day = out.sales("sales_per_day").read(spark)
    mon = out.sales("sales_per_month").read(spark)
    null_s, null_d, null_i = (F.lit(None).cast(t) for t in ("string", "date", "int"))
    return (cat.select(F.lit("category").alias("rollup"), "transaction_date", "category",
                       null_i.alias("year"), null_i.alias("month"), "total_sales")
            .unionByName(day.select(F.lit("day").alias("rollup"), "transaction_date",
                                    null_s.alias("category"), null_i.alias("year"),
                                    null_i.alias("month"), "total_sales"))
            .unionByName(mon.select(F.lit("month").alias("rollup"), null_d.alias("transaction_date"),
                                    null_s.alias("category"), "year", "month", "total_sales")))


def _arrival_by_amount(part: DataFrame) -> DataFrame:
    """Records of one id in one file, larger amounts first: the last write of
    an id is *not* its newest date, so the order of arrival has to decide."""
    return (part.repartition("transaction_id")
            .sortWithinPartitions(F.desc("total_amount"), "product_id", "transaction_date", "product_quantity"))


def stream_transactions(spark, sf_dir):
    """Transaction job's keyed upsert: last record to arrive per id, across batches."""
    out = jobs.Outputs(work_path(spark, "stream_transactions"))
    in_dir = out.path("_input")
    tx = _tx(spark, sf_dir)

    def run():
        raw = files.read_records_stream(spark, in_dir)
        _landing, table = jobs.land_transactions(raw, out, AVAILABLE_NOW)
        jobs.await_all([jobs.start_transactions_table(table.stream(spark), out, trigger=AVAILABLE_NOW)])

    feed_in_chunks(tx, "transaction_date", in_dir, run, arrange=_arrival_by_amount,
                   value=codec.encode_transactions(tx, "millis"))
    return ntz(out.transactions().read(spark))


def stream_quarantine(spark, sf_dir):
    """Dead letters of the event stream, counted per reason."""
    from basketry.plans.queries import damaged_event
    out = jobs.Outputs(work_path(spark, "stream_quarantine"))
    in_dir = out.path("_input")
    env = _env(spark, sf_dir)
    landed = []

    def run():
        raw = files.read_records_stream(spark, in_dir)
        landed.append(jobs.land_events(raw, out, AVAILABLE_NOW)[1])

    feed_in_chunks(env, "event_ts", in_dir, run, value=damaged_event(codec.encode_events(env)))
    return landed[-1].dead_letters(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def stream_transaction_quarantine(spark, sf_dir):
    """Dead letters of the transaction stream, null keys included, and the money of the rows kept."""
    from basketry.functions.money import money_sum
    from basketry.plans.queries import damaged_transactions
    out = jobs.Outputs(work_path(spark, "stream_transaction_quarantine"))
    in_dir = out.path("_input")
    tx, value = damaged_transactions(spark, sf_dir)
    landed = []

    def run():
        raw = files.read_records_stream(spark, in_dir)
        landed.append(jobs.land_transactions(raw, out, AVAILABLE_NOW)[1])

    feed_in_chunks(tx, "transaction_date", in_dir, run, value=value)
    dead = landed[-1].dead_letters(spark).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    good = landed[-1].read(spark).agg(F.lit("ok").alias("reason"), F.count(F.lit(1)).alias("n_rows"),
                                      money_sum("total_amount").alias("total"))
    return dead.withColumn("total", F.lit(None).cast("double")).unionByName(good)


#: Event-time bounds of the registered replay (UTC).
REPLAY_FROM, REPLAY_TO = "2024-01-10 00:00:00", "2024-01-12 06:30:00"


def replay_active_users(spark, sf_dir):
    """Back-fill: stored wire records read as a batch, cut to two bounds, through the batch operator."""
    from basketry.operators.active_users import active_users
    env = _env(spark, sf_dir)
    folder = work_path(spark, "replay_active_users")
    env.select(codec.encode_events(env).alias("value")).write.text(folder)
    events = jobs.replay_events(files.read_records(spark, folder), REPLAY_FROM, REPLAY_TO)
    return ntz(active_users(events))


def stream_running_totals(spark, sf_dir):
    """The running reduces as streams: last total per category and per month number."""
    out = jobs.Outputs(work_path(spark, "stream_running_totals"))
    in_dir = out.path("_input")
    tx = _tx(spark, sf_dir)

    def run():
        _landing, table = jobs.land_transactions(files.read_records_stream(spark, in_dir), out, AVAILABLE_NOW)
        jobs.await_all(jobs.start_running_totals(table.stream(spark), out, trigger=AVAILABLE_NOW))

    feed_in_chunks(tx, "transaction_date", in_dir, run, value=codec.encode_transactions(tx, "millis"))
    category = out.running("running_per_category").read(spark)
    month = out.running("running_per_month").read(spark)
    null_s, null_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    return (category.select("category", null_i.alias("month"), null_i.alias("stored_year"), "total_sales")
            .unionByName(month.select(null_s.alias("category"), "month", "stored_year", "total_sales")))


STREAM_QUERIES = {
    "replay_active_users": replay_active_users,
    "stream_running_totals": stream_running_totals,
    "stream_active_users": stream_active_users,
    "stream_top_products": stream_top_products,
    "stream_abandoned_carts": stream_abandoned_carts,
    "stream_abandoned_cart_timers": stream_abandoned_cart_timers,
    "stream_sales_rollups": stream_sales_rollups,
    "stream_transactions": stream_transactions,
    "late_rows": late_rows,
    "stream_quarantine": stream_quarantine,
    "stream_transaction_quarantine": stream_transaction_quarantine,
}

# --- oracles -------------------------------------------------------------------

_MS_CART_NEXT = """
SELECT cart_id, ts, is_checkout,
       lead(ts) OVER (PARTITION BY cart_id ORDER BY ts, is_checkout) AS next_ts
FROM (SELECT cart_id, date_trunc('millisecond', ts) AS ts, is_checkout FROM cart_events)"""

STREAM_ORACLE = {
    "stream_active_users": sql("""
        SELECT minute_ts, users FROM active
        WHERE minute_ts <= (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 5 SECOND
                            FROM events_env)""", "active", "events_env"),
    "stream_top_products": sql("""
        SELECT hour_ts, product_id, amount, product_rank FROM top10
        WHERE hour_ts + INTERVAL 1 HOUR <= (
            SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 5 SECOND
            FROM events_env)""", "top10", "events_env"),
    # emitted when the watermark passes add + T
    "stream_abandoned_cart_timers": sql("""
        SELECT cart_id, ts + INTERVAL 30 MINUTE AS abandoned_at FROM ms_next
        WHERE is_checkout = 0 AND (next_ts IS NULL OR next_ts > ts + INTERVAL 30 MINUTE)
          AND ts + INTERVAL 30 MINUTE < (
              SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 5 SECOND
              FROM events_env)""", "cart_events", "events_env",
                                        extra={"ms_next": _MS_CART_NEXT}),
    # emitted when the window [slice(add), slice(add) + 2T) closes
    "stream_abandoned_carts": sql("""
        SELECT cart_id, ts + INTERVAL 30 MINUTE AS abandoned_at FROM ms_next
        WHERE is_checkout = 0 AND (next_ts IS NULL OR next_ts > ts + INTERVAL 30 MINUTE)
          AND (epoch_us(ts) // 1800000000 + 2) * 1800000000 <= (
              SELECT epoch_us(date_trunc('millisecond', max(event_ts)) - INTERVAL 5 SECOND)
              FROM events_env)""", "cart_events", "events_env",
                                  extra={"ms_next": _MS_CART_NEXT}),
    "stream_sales_rollups": sql("""
        SELECT 'category' AS rollup, transaction_date, category, CAST(NULL AS INTEGER) AS "year",
               CAST(NULL AS INTEGER) AS "month", CAST(total AS DOUBLE) AS total_sales FROM cat_daily
        UNION ALL
        SELECT 'day', CAST(transaction_date AS DATE), NULL, NULL, NULL,
               CAST(sum(CAST(total_amount AS DECIMAL(28,8))) AS DOUBLE) FROM tx GROUP BY 2
        UNION ALL
        SELECT 'month', NULL, NULL, "year", "month", CAST(total AS DOUBLE) FROM monthly""",
                                "cat_daily", "tx", "monthly"),
    # last to arrive: newest third of the time span, then the order within it
    "stream_transactions": sql("""
        SELECT * EXCLUDE (chunk, rn, lo, hi) FROM (
          SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY chunk DESC,
                 total_amount ASC, product_id DESC, transaction_date DESC, product_quantity DESC) AS rn
          FROM (SELECT *, (epoch_us(CAST(transaction_date AS TIMESTAMP)) - lo) // ((hi - lo) // 3 + 1) AS chunk
                FROM tx, (SELECT min(epoch_us(CAST(transaction_date AS TIMESTAMP))) AS lo,
                                 max(epoch_us(CAST(transaction_date AS TIMESTAMP))) AS hi FROM tx)))
        WHERE rn = 1""", "tx"),
    "stream_quarantine": """
        SELECT CASE event_id % 50 WHEN 0 THEN 'malformed' WHEN 1 THEN 'unknown_field'
                                  ELSE 'bad_type' END AS reason,
               count(*) AS n_rows
        FROM events WHERE event_id % 50 IN (0, 1, 2) GROUP BY 1""",
}

STREAM_ORACLE["replay_active_users"] = f"""
        WITH e AS (SELECT CAST(user_id AS VARCHAR) AS u, date_trunc('millisecond', ts) AS t FROM events
                   WHERE event_type = 'view' AND date_trunc('millisecond', ts) >= TIMESTAMP '{REPLAY_FROM}'
                     AND date_trunc('millisecond', ts) < TIMESTAMP '{REPLAY_TO}'),
        w AS (SELECT u, date_trunc('minute', t) + INTERVAL 1 MINUTE * (k + 1) AS minute_ts
              FROM e, range(5) AS r(k))
        SELECT minute_ts, count(DISTINCT u) AS users FROM w GROUP BY 1"""
# the last rows of the batch running totals
STREAM_ORACLE["stream_running_totals"] = sql("""
        SELECT product_category AS category, CAST(NULL AS INTEGER) AS "month", CAST(NULL AS INTEGER) AS stored_year,
               CAST(sum(CAST(total_amount AS DECIMAL(28,8))) AS DOUBLE) AS total_sales FROM tx GROUP BY 1
        UNION ALL
        SELECT NULL, CAST(month(transaction_date) AS INTEGER), CAST(min(year(transaction_date)) AS INTEGER),
               CAST(sum(CAST(total_amount AS DECIMAL(28,8))) AS DOUBLE) FROM tx GROUP BY month(transaction_date)""", "tx")
# the dead letters of the batch query
STREAM_ORACLE["stream_transaction_quarantine"] = ORACLE["quarantine_transactions"]
# Late copies never reach a window: the result is the on-time stream's.
STREAM_ORACLE["late_rows"] = STREAM_ORACLE["stream_active_users"]
