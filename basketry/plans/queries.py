"""Registered queries: (spark, sf_dir) -> DataFrame, one per operator key.

Every query reads the driver's tables through the adapters, so its work
grows with them.  Batch results return ``timestamp_ntz`` columns (the
tables' own timestamp type) so that they compare with DuckDB's TIMESTAMP.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions import codec
from basketry.functions.money import money_sum
from basketry.functions.timeparse import event_time
from basketry.operators import active_users as au_ops
from basketry.operators import carts, documents, events, sales, serving
from basketry.operators import top_products as tp_ops
from basketry.session import apply_runtime_conf
from basketry.sources import adapters

# Fixed parameters of the registered queries.
SERVE_HOUR = "2024011512"
AS_OF = "2024-01-15 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def ntz(df: DataFrame) -> DataFrame:
    """Cast instant timestamps to timestamp_ntz (UTC wall clock)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _env(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return adapters.events_envelope(spark, sf_dir)


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    return adapters.transactions(spark, sf_dir)


ENVELOPE_OUT = schemas.EVENT_COLUMNS + ["event_ts"]


# --- routing and projections ----------------------------------------------

def route_page_views(spark, sf_dir):
    return ntz(events.page_views(_env(spark, sf_dir)).select(*ENVELOPE_OUT))


def route_add_to_cart(spark, sf_dir):
    return ntz(events.add_to_carts(_env(spark, sf_dir)).select(*ENVELOPE_OUT))


def route_checkout(spark, sf_dir):
    return ntz(events.checkouts(_env(spark, sf_dir)).select(*ENVELOPE_OUT))


def event_refs(spark, sf_dir):
    return events.event_refs(_env(spark, sf_dir))


def product_sales(spark, sf_dir):
    return ntz(events.product_sales(_env(spark, sf_dir)))


def _keyed_env(spark, sf_dir):
    """Envelope with some empty / missing user ids, to exercise the key chain."""
    env = _env(spark, sf_dir)
    m = F.col("eventId").cast("bigint") % 7
    return env.withColumn("userId", F.when(m == 0, F.lit(""))
                          .when(m == 1, F.lit(None).cast("string"))
                          .otherwise(F.col("userId")))


def event_message_key(spark, sf_dir):
    return _keyed_env(spark, sf_dir).select("eventId", events.message_key().alias("key"))


def _time_texts(spark, sf_dir):
    """Event-time texts in eight shapes, and a record time per row."""
    ev = adapters.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    ts = F.col("ts").cast("timestamp")
    plus2 = ts + F.expr("INTERVAL 2 HOURS")
    m = F.col("event_id") % 8
    text = (F.when(m == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .when(m == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
            .when(m == 2, F.date_format(plus2, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'"))
            .when(m == 3, F.date_format(plus2, "yyyy-MM-dd'T'HH:mm'+02:00'"))
            .when(m == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
            .when(m == 5, F.lit("garbage"))
            .when(m == 6, F.lit(None).cast("string"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd")))
    return ev.select(F.col("event_id").cast("string").alias("eventId"),
                     text.alias("timestamp"),
                     F.date_trunc("second", ts).alias("record_ts"))


def event_time_q(spark, sf_dir):
    apply_runtime_conf(spark)
    t = _time_texts(spark, sf_dir)
    return ntz(t.select("eventId", event_time("timestamp", "record_ts").alias("event_ts")))


# --- decoding ---------------------------------------------------------------

def _body(value: Column) -> Column:
    """A JSON object's text without its last brace."""
    return F.substring(value, F.lit(1), F.length(value) - 1)


def damaged_event(value: Column) -> Column:
    """A JSON message damaged by event id: % 50 = 0 not JSON, 1 an unknown
    field, 2 a non-numeric price."""
    m = F.col("eventId").cast("bigint") % 50
    return (F.when(m == 0, F.lit("not json"))
            .when(m == 1, F.concat(_body(value), F.lit(',"zzz":1}')))
            .when(m == 2, F.concat(_body(value), F.lit(',"productPrice":"abc"}')))
            .otherwise(value))


def damage_messages(msgs: DataFrame) -> DataFrame:
    return msgs.withColumn("value", damaged_event(F.col("value")))


def _decoded_events(spark, sf_dir, damage: bool = False):
    env = _env(spark, sf_dir)
    msgs = env.select("eventId", "event_ts", codec.encode_events(env).alias("value"))
    if damage:
        msgs = damage_messages(msgs)
    # the record time of a message is its event time in whole seconds
    msgs = msgs.withColumn("record_ts", F.date_trunc("second", "event_ts"))
    return codec.decode_events(msgs, keep=["record_ts"])


def decode_events(spark, sf_dir):
    good, _ = codec.split(_decoded_events(spark, sf_dir))
    good = good.withColumn("event_ts", event_time("timestamp", "record_ts"))
    return ntz(good.select(*ENVELOPE_OUT))


def quarantine_events(spark, sf_dir):
    d = _decoded_events(spark, sf_dir, damage=True)
    return (d.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("reason"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


def damaged_transactions(spark, sf_dir) -> tuple[DataFrame, Column]:
    """Transactions and their messages (a column made of theirs), damaged by order: % 40 = 0 not JSON, 1 an
    unknown field, 2 a non-numeric amount, 3 no category, 4 no id.  Amounts have three decimals and more."""
    tx = _tx(spark, sf_dir)
    m = F.split("transaction_id", "-")[0].cast("bigint") % 40
    tx = tx.withColumns({"m": m, "total_amount": F.col("total_amount") + 0.001,
                         "product_category": F.when(m != 3, F.col("product_category")),
                         "transaction_id": F.when(m != 4, F.col("transaction_id"))})
    value = codec.encode_transactions(tx, "millis")
    return tx, (F.when(F.col("m") == 0, F.lit("not json"))
                .when(F.col("m") == 1, F.concat(_body(value), F.lit(',"zzz":1}')))
                .when(F.col("m") == 2, F.concat(_body(value), F.lit(',"totalAmount":"abc"}'))).otherwise(value))


def quarantine_transactions(spark, sf_dir):
    """Dead transactions per reason, and the rows and money that stay."""
    tx, value = damaged_transactions(spark, sf_dir)
    d = codec.dead_null_keys(codec.decode_transactions(tx.select(value.alias("value"))))
    ok = F.col("reason").isNull()
    return (d.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("reason"))
             .agg(F.count(F.lit(1)).alias("n_rows"), money_sum(F.when(ok, F.col("totalAmount"))).alias("total")))


def decode_transactions(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    as_millis = F.substring("transaction_id", -1, 1).cast("int") % 2 == 0
    value = F.when(as_millis, codec.encode_transactions(tx, "millis")) \
             .otherwise(codec.encode_transactions(tx, "iso"))
    good, _ = codec.split(codec.decode_transactions(tx.select(value.alias("value"))))
    return ntz(codec.transactions_from_records(good))


def event_messages(spark, sf_dir):
    msgs = events.event_messages(_keyed_env(spark, sf_dir))
    dec = codec.decode_events(msgs, keep=["key"]).filter(F.col("reason").isNull())
    dec = dec.withColumn("event_ts", event_time("timestamp", F.lit(None)))
    return ntz(dec.select("key", "eventId", "eventType", "userId", "cartId", "productId",
                          "productQuantity", "totalAmount", "event_ts"))


# --- active users -------------------------------------------------------------

def _active(spark, sf_dir):
    return au_ops.active_users(_env(spark, sf_dir))


def active_users_5m(spark, sf_dir):
    return ntz(_active(spark, sf_dir))


def latest_active_users(spark, sf_dir):
    return ntz(serving.latest_active_users(_active(spark, sf_dir)))


def active_users_rows(spark, sf_dir):
    return serving.table_rows(_active(spark, sf_dir), "n_rows")


def serve_active_users(spark, sf_dir):
    return serving.current_active_users(_active(spark, sf_dir))


# --- top products -------------------------------------------------------------

def product_sales_hourly(spark, sf_dir):
    return ntz(tp_ops.product_sales_windowed(_env(spark, sf_dir)))


def _top(spark, sf_dir, n=10, window="1 hour"):
    return tp_ops.top_products(_env(spark, sf_dir), n, window)


def top_products_hourly(spark, sf_dir):
    return ntz(_top(spark, sf_dir))


def top_products_hourly_n2(spark, sf_dir):
    return ntz(_top(spark, sf_dir, 2))


def top_products_daily(spark, sf_dir):
    return ntz(_top(spark, sf_dir, 10, "1 day"))


def top_products_nested(spark, sf_dir):
    nested = tp_ops.nest_top_n(_top(spark, sf_dir))
    return nested.select(
        "hour_key", "window_start_ms",
        F.size("top_n").cast("bigint").alias("n_items"),
        F.concat_ws(",", F.transform("top_n", lambda x: x["product_id"])).alias("top_n_ids"),
        F.col("top_n")[0]["product_id"].alias("first_product_id"),
        F.col("top_n")[0]["amount"].alias("first_amount"))


def top_products_flatten(spark, sf_dir):
    return ntz(tp_ops.flatten_top_n(tp_ops.nest_top_n(_top(spark, sf_dir))))


def latest_top_products(spark, sf_dir):
    return ntz(serving.latest_top_products(_top(spark, sf_dir)))


def search_top_products(spark, sf_dir):
    return ntz(serving.search_top_products(_top(spark, sf_dir)))


def serve_top_products(spark, sf_dir):
    one_hour = serving.events_of_hour(_env(spark, sf_dir), SERVE_HOUR)
    return serving.top_products_for_hour(tp_ops.top_products(one_hour), SERVE_HOUR)


# --- carts ------------------------------------------------------------------------

def abandoned_carts(spark, sf_dir):
    return ntz(carts.abandoned_carts(_env(spark, sf_dir)))


def abandoned_carts_6h(spark, sf_dir):
    return ntz(carts.abandoned_carts(_env(spark, sf_dir), "6 hours"))


def abandoned_carts_asof(spark, sf_dir):
    return ntz(carts.abandoned_carts(_env(spark, sf_dir), as_of=AS_OF))


def abandoned_carts_count(spark, sf_dir):
    return carts.abandoned_count(carts.abandoned_carts(_env(spark, sf_dir)))


def abandoned_carts_recent(spark, sf_dir):
    return ntz(carts.recent_abandoned(carts.abandoned_carts(_env(spark, sf_dir))))


def metric_labels(spark, sf_dir):
    env = _env(spark, sf_dir)
    a = events.active_users_label(au_ops.active_users(env))
    t = events.top_n_label(tp_ops.nest_top_n(tp_ops.top_products(env)))
    c = events.abandoned_label(carts.abandoned_carts(env))
    return a.unionByName(t).unionByName(c)


# --- transactions and sales ------------------------------------------------------

def transactions_latest(spark, sf_dir):
    return ntz(sales.latest_transactions(_tx(spark, sf_dir)))


def sales_per_category(spark, sf_dir):
    return sales.sales_per_category(_tx(spark, sf_dir))


def sales_per_category_running(spark, sf_dir):
    return sales.sales_per_category_running(_tx(spark, sf_dir))


def sales_per_day(spark, sf_dir):
    return sales.sales_per_day(_tx(spark, sf_dir))


def sales_per_month(spark, sf_dir):
    return sales.sales_per_month(_tx(spark, sf_dir))


def sales_per_month_running(spark, sf_dir):
    return sales.sales_per_month_running(_tx(spark, sf_dir))


# --- documents ----------------------------------------------------------------------

def _reread(docs: DataFrame, schema: str, fields: dict[str, str]) -> DataFrame:
    """(doc_index, id) + fields parsed back from the document (one parse)."""
    d = docs.select(F.col("index").alias("doc_index"), "id",
                    F.from_json("doc", schema).alias("d"))
    return d.select("doc_index", "id", *[F.col(f"d.{src}").alias(dst) for src, dst in fields.items()])


def doc_transactions(spark, sf_dir):
    docs = documents.transaction_docs(sales.latest_transactions(_tx(spark, sf_dir)))
    return _reread(docs, "transactionId string, productId string, productQuantity int, "
                         "totalAmount double, customerId string, transactionDate bigint, "
                         "paymentMethod string",
                   {"transactionId": "transaction_id", "productId": "product_id",
                    "productQuantity": "product_quantity", "totalAmount": "total_amount",
                    "customerId": "customer_id", "transactionDate": "transaction_date_ms",
                    "paymentMethod": "payment_method"})


def doc_active_users(spark, sf_dir):
    docs = documents.active_user_docs(_active(spark, sf_dir))
    return _reread(docs, "minute_ts bigint, users bigint",
                   {"minute_ts": "minute_ts_ms", "users": "users"})


def doc_top_products(spark, sf_dir):
    docs = documents.top_product_docs(_top(spark, sf_dir))
    return _reread(docs, "hour_ts bigint, product_id string, amount double",
                   {"hour_ts": "hour_ts_ms", "product_id": "product_id", "amount": "amount"})


QUERIES: dict[str, Query] = {
    "route_page_views": route_page_views,
    "route_add_to_cart": route_add_to_cart,
    "route_checkout": route_checkout,
    "event_refs": event_refs,
    "product_sales": product_sales,
    "event_message_key": event_message_key,
    "event_time": event_time_q,
    "decode_events": decode_events,
    "decode_transactions": decode_transactions,
    "event_messages": event_messages,
    "quarantine_events": quarantine_events,
    "quarantine_transactions": quarantine_transactions,
    "active_users_5m": active_users_5m,
    "latest_active_users": latest_active_users,
    "active_users_rows": active_users_rows,
    "serve_active_users": serve_active_users,
    "product_sales_hourly": product_sales_hourly,
    "top_products_hourly": top_products_hourly,
    "top_products_hourly_n2": top_products_hourly_n2,
    "top_products_daily": top_products_daily,
    "top_products_nested": top_products_nested,
    "top_products_flatten": top_products_flatten,
    "metric_labels": metric_labels,
    "latest_top_products": latest_top_products,
    "search_top_products": search_top_products,
    "serve_top_products": serve_top_products,
    "abandoned_carts": abandoned_carts,
    "abandoned_carts_6h": abandoned_carts_6h,
    "abandoned_carts_asof": abandoned_carts_asof,
    "abandoned_carts_count": abandoned_carts_count,
    "abandoned_carts_recent": abandoned_carts_recent,
    "transactions_latest": transactions_latest,
    "sales_per_category": sales_per_category,
    "sales_per_category_running": sales_per_category_running,
    "sales_per_day": sales_per_day,
    "sales_per_month": sales_per_month,
    "sales_per_month_running": sales_per_month_running,
    "doc_transactions": doc_transactions,
    "doc_active_users": doc_active_users,
    "doc_top_products": doc_top_products,
}
