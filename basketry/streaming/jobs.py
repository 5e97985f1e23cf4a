"""Structured Streaming wiring of the two jobs.

Both jobs land their topic first: one stream decodes every record once into
typed Parquet (``landing.py``), dead letters included.  The metric streams read
the landing table.
Multi-event job: event time with a 5 s watermark -> active users, hourly top
products, abandoned carts.
Transaction job: last-write-wins table and the sales roll-ups (one update-mode
aggregate, no watermark).

Each metric is its own streaming query with its own checkpoint (Spark runs
one stateful plan per query); every sink is a replay-safe ``foreachBatch``
writer, so a restarted query that re-runs a batch leaves the same result.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import schemas
from basketry.functions import codec
from basketry.functions.money import PARTS, folded_parts, money_parts, money_total
from basketry.functions.timeparse import event_time
from basketry.operators import active_users as au_ops
from basketry.operators import carts, documents
from basketry.operators import top_products as tp_ops
from basketry.streaming.landing import Landing, shelved
from basketry.streaming.writers import (BatchLog, BucketTable, Fanout, JdbcTable, LatestSlot,
                                        ReplaceByKey, SearchIndex)

WATERMARK = "5 seconds"
CHECKPOINT_INTERVAL = "10 seconds"
#: Landed columns that give the order of writes: place in the source (Kafka
#: offset, or time and place of the file), then place among the rows read together.
ARRIVAL = ["arrival", "seq"]


def event_rows(raw: DataFrame, mode: str = "quarantine") -> DataFrame:
    """(value, record_ts) records -> decoded envelope, event_ts, value and reason."""
    decoded = codec.decode_events(raw.select("value", "record_ts"), keep=["record_ts"], mode=mode)
    return decoded.withColumn("event_ts", event_time("timestamp", "record_ts")).drop("record_ts")


def decode_event_stream(raw: DataFrame, watermark: str | None = WATERMARK,
                        mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """(value, record_ts) records -> (events with event_ts + watermark, dead
    letters), without a landing table (a single consumer)."""
    good, bad = codec.split(event_rows(raw, mode))
    return (good.withWatermark("event_ts", watermark) if watermark else good), bad


def transaction_rows(raw: DataFrame, mode: str = "quarantine") -> DataFrame:
    """(value, record_ts, arrival) records -> transactions in table form, their
    order of arrival, value and reason."""
    decoded = codec.dead_null_keys(codec.decode_transactions(raw, keep=["arrival"], mode=mode))
    return codec.transactions_from_records(decoded, keep=["arrival", "value", "reason"])


@dataclass
class Outputs:
    """Result locations of one deployment, all under one shared root.

    ``jdbc`` (optional): ``{"url": ..., "props": {...}, "dialect":
    "postgres" | "merge"}`` — keyed results are then also upserted into the
    database tables of ``schemas.DDL`` (staging table + one statement per
    micro-batch), from the same persisted batch.  ``search`` (optional):
    ``{"format": ..., "options": {...}}`` — transactions, active users and top
    products are then also written as search documents with that connector.
    ``transaction_buckets``: folders of the transactions table, for about a
    hundred MB each at the table's expected size.
    """

    root: str
    jdbc: dict | None = None
    search: dict | None = None
    transaction_buckets: int = 64

    def with_database(self, files_sink, table: str, columns: list[str] | None = None,
                      replace_key: str | None = None, batch_size: int = 500, to_docs=None):
        """``files_sink``, fanned out to the database table and the search
        index (``to_docs`` shapes its documents) where configured."""
        sinks, shapes = [files_sink], {}
        if self.jdbc:
            if columns:
                shapes[len(sinks)] = lambda d: d.select(*columns)
            sinks.append(JdbcTable(self.jdbc["url"], table, schemas.TABLE_KEYS[table],
                                   self.jdbc.get("props"), self.jdbc.get("dialect", "postgres"),
                                   batch_size=batch_size, replace_key=replace_key))
        if self.search and to_docs:
            sinks.append(SearchIndex(to_docs, self.search["format"], self.search.get("options")))
        return Fanout(*sinks, shapes=shapes) if len(sinks) > 1 else files_sink

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def checkpoint(self, name: str) -> str:
        return os.path.join(self.root, "_checkpoints", name)

    # --- result tables ---------------------------------------------------
    # Tables that keep one row per key; the bucket count follows the table's
    # expected size, since a batch rewrites the buckets it touches.
    def active_users(self) -> BucketTable:
        """Bucketed by day: a batch touches the days whose windows it closes."""
        return BucketTable(self.path("active_users_minute"), ["minute_ts"], _AU_SCHEMA,
                           bucket=lambda: F.date_format("minute_ts", "yyyyMMdd").cast("int"))

    def active_users_slot(self) -> LatestSlot:
        return LatestSlot(self.path("latest_metrics"), "active_users_5m")

    def top_products(self) -> ReplaceByKey:
        return ReplaceByKey(self.path("top_products_hourly"), "hour_key", _TOP_SCHEMA)

    def abandoned(self) -> BatchLog:
        return BatchLog(self.path("abandoned_carts"), _AB_SCHEMA)

    def transactions(self) -> BucketTable:
        return BucketTable(self.path("transactions"), ["transaction_id"], _TX_SCHEMA,
                           buckets=self.transaction_buckets)

    def sales(self, name: str) -> BucketTable:
        """Bucketed by month: a batch touches the months of its transactions."""
        keys, schema, month = {
            "sales_per_category": (["transaction_date", "category"],
                                   "transaction_date date, category string", "transaction_date"),
            "sales_per_day": (["transaction_date"], "transaction_date date", "transaction_date"),
            "sales_per_month": (["year", "month"], "year int, month int", None)}[name]
        bucket = ((lambda: F.date_format(month, "yyyyMM").cast("int")) if month
                  else (lambda: F.col("year") * 100 + F.col("month")))
        return BucketTable(self.path(name), keys, f"{schema}, total_sales double, {_PARTS_SCHEMA}",
                           bucket=bucket, hidden=PARTS)

    def running(self, name: str) -> BucketTable:
        keys, schema = {"running_per_category": (["category"], "category string"),
                        "running_per_month": (["month"], "month int, stored_year int")}[name]
        return BucketTable(self.path(name), keys, f"{schema}, total_sales double", buckets=1)

    def events_landing(self, schema) -> Landing:
        return Landing(self.path("landing_events"), schema)

    def transactions_landing(self, schema) -> Landing:
        return Landing(self.path("landing_transactions"), schema, ordered=True)

    def dead_letters(self, spark: SparkSession, topic: str) -> DataFrame:
        """(value, reason) of the ``events`` or ``transactions`` that could not be decoded."""
        schema = event_schema() if topic == "events" else transaction_schema()
        table = self.events_landing(schema) if topic == "events" else self.transactions_landing(schema)
        return table.dead_letters(spark)


def event_schema() -> str:
    return ", ".join(f"{n} {t}" for n, t in schemas.EVENT_FIELDS) + ", event_ts timestamp, value string, reason string"


def transaction_schema() -> str:
    return _TX_SCHEMA + ", value string, reason string"


_AU_SCHEMA = "minute_ts timestamp, users bigint"
_TOP_SCHEMA = "hour_ts timestamp, product_id string, amount double, product_rank bigint, hour_key string"
_AB_SCHEMA = "cart_id string, abandoned_at timestamp"
_TX_SCHEMA = ", ".join(f"{schemas.snake(n)} {t}" for n, t in schemas.TRANSACTION_FIELDS)
_PARTS_SCHEMA = "exact decimal(38,8), approx double, wide boolean"


def _start(df: DataFrame, name: str, out: Outputs, batch_fn, output_mode: str,
           trigger: dict | None) -> StreamingQuery:
    w = (df.writeStream.queryName(name).outputMode(output_mode)
           .option("checkpointLocation", out.checkpoint(name))
           .foreachBatch(batch_fn))
    w = w.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
    return w.start()


def start_active_users(events: DataFrame, out: Outputs, trigger: dict | None = None
                       ) -> StreamingQuery:
    """Active users per window, emitted once the window closes (append)."""
    sink = out.with_database(out.active_users(), "active_users_minute",
                             to_docs=documents.active_user_docs)
    slot = out.active_users_slot()

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()      # one row per closed minute
        try:
            sink.write_batch(df, batch_id)
            slot.write_batch(df, "minute_ts", "users", batch_id)
        finally:
            df.unpersist()

    return _start(au_ops.active_users_stream(events), "active_users", out, batch, "append", trigger)


def start_top_products(events: DataFrame, out: Outputs, n: int = tp_ops.TOP_N,
                       window: str = tp_ops.HOUR, trigger: dict | None = None
                       ) -> StreamingQuery:
    """Hourly sums close in append mode; each closed hour is ranked in the
    batch (all its rows arrive together) and replaces its partition."""
    # each closed hour replaces its members in both stores (no leftovers)
    sink = out.with_database(out.top_products(), "top_products_hourly",
                             ["hour_ts", "product_id", "amount"], replace_key="hour_ts",
                             to_docs=documents.top_product_docs)

    def batch(df: DataFrame, batch_id: int) -> None:
        top = tp_ops.top_n(df, n).withColumn("hour_key", F.date_format("hour_ts", "yyyyMMddHH"))
        sink.write_batch(top, batch_id)

    return _start(tp_ops.product_sales_windowed(events, window), "top_products", out,
                  batch, "append", trigger)


def start_abandoned_carts(events: DataFrame, out: Outputs, timeout: str = carts.TIMEOUT,
                          trigger: dict | None = None, resolution: int = 1,
                          low_latency: bool = False) -> StreamingQuery:
    """Abandoned carts, emitted when their window closes.

    Default: the skew-safe windowed aggregate (emits within T/resolution
    after ``add + T``).  ``low_latency``: session windows (emit at
    ``add + T``; each cart's micro-batch events are sorted in one task).
    """
    log = out.abandoned()
    df = (carts.abandoned_carts_sessions(events, timeout) if low_latency
          else carts.abandoned_carts(events, timeout, resolution=resolution))
    return _start(df, "abandoned_carts", out, log.write_batch, "append", trigger)


def start_console(df: DataFrame, name: str, output_mode: str = "append",
                  trigger: dict | None = None) -> StreamingQuery:
    """Print a stream (debugging only; off unless asked for)."""
    w = df.writeStream.queryName(name).outputMode(output_mode).format("console") \
        .option("truncate", "false")
    return w.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def start_kafka_publish(events: DataFrame, out: Outputs, kafka_write_options: dict,
                        trigger: dict | None = None) -> StreamingQuery:
    """Publish typed events as Kafka messages: key chain + compact JSON."""
    from basketry.operators.events import event_messages
    w = (event_messages(events).writeStream.queryName("publish").format("kafka")
         .option("checkpointLocation", out.checkpoint("publish")))
    for k, v in kafka_write_options.items():
        w = w.option(k, v)
    return w.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).start()


def _start_cart_timers(df: DataFrame, name: str, out: Outputs, trigger: dict | None) -> StreamingQuery:
    """The timer machines need the RocksDB state store provider.

    A query takes the session's settings when it starts (and keeps the
    provider in its checkpoint), so the setting holds for the start only.
    """
    from basketry.streaming.stateful import ROCKSDB
    log = BatchLog(out.path(name), _AB_SCHEMA)
    conf, key = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, ROCKSDB)
    try:
        return _start(df, name, out, log.write_batch, "append", trigger)
    finally:
        conf.set(key, before)


def start_abandoned_carts_processing_time(events: DataFrame, out: Outputs,
                                          timeout: str = carts.TIMEOUT,
                                          trigger: dict | None = None) -> StreamingQuery:
    """E3: the wall-clock timer machine (``transformWithStateInPandas``)."""
    from basketry.streaming.stateful import abandoned_carts_processing_time
    return _start_cart_timers(abandoned_carts_processing_time(events, timeout),
                              "abandoned_carts_pt", out, trigger)


def start_abandoned_carts_event_time(events: DataFrame, out: Outputs,
                                     timeout: str = carts.TIMEOUT,
                                     trigger: dict | None = None) -> StreamingQuery:
    """E3/E4 with event-time timers: a cart is emitted when the watermark passes ``add + T``."""
    from basketry.streaming.stateful import abandoned_carts_event_time
    return _start_cart_timers(abandoned_carts_event_time(events, timeout),
                              "abandoned_carts_et", out, trigger)


def replay_events(raw: DataFrame, start=None, end=None, mode: str = "quarantine") -> DataFrame:
    """Batch: the good events of bounded records (``read_kafka_range``, ``read_records``)
    with event times in [start, end), for the batch operators.

    A back-fill reads a record range that surely holds the wanted event
    times; the bounds here then cut it to them.
    """
    events, _ = codec.split(event_rows(raw, mode))
    if start is not None:
        events = events.where(F.col("event_ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        events = events.where(F.col("event_ts") < F.lit(end).cast("timestamp"))
    return events


def _land(rows: DataFrame, table: Landing, name: str, out: Outputs, trigger: dict | None) -> StreamingQuery:
    trigger = trigger or {"processingTime": CHECKPOINT_INTERVAL}
    q = table.start(rows, name, out.checkpoint(name), trigger)
    if trigger.get("availableNow") or trigger.get("once"):
        await_all([q])      # readers then find all that was available
    return q


def land_events(raw: DataFrame, out: Outputs, trigger: dict | None = None,
                mode: str = "quarantine") -> tuple[StreamingQuery, Landing]:
    """The one stream that reads and decodes the topic, and its landing table."""
    rows = event_rows(raw, mode)
    rows = shelved(rows, F.col("event_ts"))
    table = out.events_landing(rows.schema)
    return _land(rows, table, "landing_events", out, trigger), table


def land_transactions(raw: DataFrame, out: Outputs, trigger: dict | None = None,
                      mode: str = "quarantine") -> tuple[StreamingQuery, Landing]:
    rows = shelved(transaction_rows(raw, mode), F.col("transaction_date"))
    table = out.transactions_landing(rows.schema)
    return _land(rows, table, "landing_transactions", out, trigger), table


def landed_events(table: Landing, spark: SparkSession, watermark: str | None = WATERMARK) -> DataFrame:
    events = table.stream(spark)
    return events.withWatermark("event_ts", watermark) if watermark else events


def start_multi_event_job(raw: DataFrame, out: Outputs, timeout: str = carts.TIMEOUT,
                          trigger: dict | None = None, console: bool = False,
                          publish: dict | None = None) -> list[StreamingQuery]:
    """All metrics of the event stream, over one decoded landing table.

    ``console`` adds the peek prints (routed event references, metric labels)
    for debugging; ``publish`` (Kafka writer options) publishes the events."""
    from basketry.operators import events as ev_ops
    landing, table = land_events(raw, out, trigger)
    events = landed_events(table, raw.sparkSession)
    queries = [landing,
               start_active_users(events, out, trigger),
               start_top_products(events, out, trigger=trigger),
               start_abandoned_carts(events, out, timeout, trigger)]
    if publish:
        queries.append(start_kafka_publish(landed_events(table, raw.sparkSession, None), out, publish, trigger))
    if console:
        queries += [
            start_console(ev_ops.event_refs(events), "peek_events", trigger=trigger),
            start_console(ev_ops.active_users_label(au_ops.active_users_stream(events)),
                          "print_active_users", trigger=trigger),
            start_console(ev_ops.abandoned_label(carts.abandoned_carts(events, timeout)),
                          "print_abandoned", trigger=trigger),
            start_top_n_labels(events, out, trigger=trigger)]
    return queries


def start_top_n_labels(events: DataFrame, out: Outputs, n: int = tp_ops.TOP_N,
                       trigger: dict | None = None) -> StreamingQuery:
    """Print a label per closed hour of top products (debugging only)."""
    from basketry.operators.events import top_n_label

    def batch(df: DataFrame, batch_id: int) -> None:
        top_n_label(tp_ops.nest_top_n(tp_ops.top_n(df, n))).show(truncate=False)

    return _start(tp_ops.product_sales_windowed(events), "print_top_products", out, batch,
                  "append", trigger)


# --- transaction job -------------------------------------------------------------

def start_transactions_table(tx: DataFrame, out: Outputs, order: list[str] | None = None,
                             trigger: dict | None = None) -> StreamingQuery:
    """Last write wins per transaction id: last to arrive within a batch
    (place in the source, then in the task), newest batch across."""
    from basketry.operators.sales import latest_transactions
    sink = out.with_database(out.transactions(), "transactions", batch_size=1000,
                             to_docs=documents.transaction_docs)
    order = order or ARRIVAL

    def batch(df: DataFrame, batch_id: int) -> None:
        if isinstance(sink, BucketTable):
            # the table finds the last write in the shuffle that also makes its files
            sink.write_batch(df, batch_id, order)
        else:
            sink.write_batch(latest_transactions(df, order).drop(*ARRIVAL), batch_id)

    return _start(tx, "transactions", out, batch, "append", trigger)


def sales_rollup_stream(tx: DataFrame) -> DataFrame:
    """The one update-mode aggregate of all roll-ups: running money parts per
    date and category.  A micro-batch emits the keys that it changes."""
    return (tx.filter(F.col("product_category").isNotNull())
              .groupBy(F.to_date("transaction_date").alias("transaction_date"),
                       F.col("product_category").alias("category"))
              .agg(*money_parts("total_amount")))


def start_sales_rollups(tx: DataFrame, out: Outputs, trigger: dict | None = None
                        ) -> StreamingQuery:
    """All three roll-up tables from one stream.

    A batch upserts the (date, category) totals that changed.  Day and month
    totals are then folded from the stored totals of the changed months: the
    stored table already holds this batch, so a re-run gives the same sums.
    """
    tables = {n: out.sales(n) for n in ("sales_per_category", "sales_per_day", "sales_per_month")}
    sinks = {n: out.with_database(t, n, [c for c in t.columns if c not in PARTS]) for n, t in tables.items()}

    def batch(df: DataFrame, batch_id: int) -> None:
        changed = df.withColumn("total_sales", money_total())
        sinks["sales_per_category"].write_batch(changed, batch_id)
        stored = tables["sales_per_category"].touched(df.sparkSession, batch_id)
        if stored is None:
            return
        days = stored.groupBy("transaction_date").agg(
            *folded_parts(), F.max("batch_id").alias("newest"))
        months = days.groupBy(F.year("transaction_date").alias("year"),
                              F.month("transaction_date").alias("month")).agg(*folded_parts())
        # days without a change keep the row they have
        new_days = days.where(F.col("newest") == batch_id).drop("newest")
        sinks["sales_per_day"].write_batch(new_days.withColumn("total_sales", money_total()), batch_id)
        sinks["sales_per_month"].write_batch(months.withColumn("total_sales", money_total()), batch_id)

    return _start(sales_rollup_stream(tx), "sales_rollups", out, batch, "update", trigger)


def running_totals_stream(tx: DataFrame) -> dict[str, DataFrame]:
    """The literal running reduces: one total per category, and one per month
    number with the least year seen, over the whole life of the stream."""
    year = F.year("transaction_date")
    return {
        "running_per_category": (tx.filter(F.col("product_category").isNotNull())
                                   .groupBy(F.col("product_category").alias("category"))
                                   .agg(*money_parts("total_amount"))),
        "running_per_month": (tx.groupBy(F.month("transaction_date").alias("month"))
                                .agg(F.min(year).alias("stored_year"), *money_parts("total_amount")))}


def start_running_totals(tx: DataFrame, out: Outputs, trigger: dict | None = None) -> list[StreamingQuery]:
    """Keyed running state without a window: each batch upserts the totals it changes.

    The state has one row per category or month, so it does not grow with the
    stream; partial sums meet before the shuffle, so a hot category does not
    gather in one task.
    """
    queries = []
    for name, agg in running_totals_stream(tx).items():
        table = out.running(name)

        def batch(df: DataFrame, batch_id: int, table=table) -> None:
            table.write_batch(df.withColumn("total_sales", money_total()), batch_id)

        queries.append(_start(agg, name, out, batch, "update", trigger))
    return queries


def start_transaction_job(raw: DataFrame, out: Outputs, trigger: dict | None = None,
                          console: bool = False) -> list[StreamingQuery]:
    """Landing (with dead letters), table and roll-ups; ``console`` also prints the decoded stream."""
    landing, table = land_transactions(raw, out, trigger)
    tx = table.stream(raw.sparkSession)
    printed = [start_console(tx.drop(*ARRIVAL), "print_transactions", trigger=trigger)] if console else []
    return [landing, start_transactions_table(tx, out, trigger=trigger),
            start_sales_rollups(tx, out, trigger)] + printed


def await_all(queries: list[StreamingQuery], timeout_s: int | None = None) -> None:
    """Wait for availableNow / once queries; surface the first failure.

    There is no time limit unless the caller sets one.
    """
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            q.stop()
            raise TimeoutError(f"stream {q.name} did not finish in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def stop_all(spark: SparkSession) -> None:
    for q in spark.streams.active:
        q.stop()

