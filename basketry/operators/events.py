"""Routing, projections and labels over the typed event envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.codec import encode_events


def event_time_gate(df: DataFrame, value: Column, ts: str = "event_ts") -> Column:
    """``value`` as seen by a routing predicate.

    On a stream the watermark must advance on *every* event (the reference
    assigns it at the source), but the optimizer pushes a filter below the
    watermark whenever the filter does not reference the event-time column —
    the watermark would then follow only the routed events, and e.g. an
    hour of add-to-carts would stay open until the next add-to-cart.
    ``hash(event_ts) >= -2**31`` holds for every event time, which the
    optimizer does not see: it ties the predicate to the event-time column,
    so it stays above the watermark.  Batch frames get the plain value (the
    predicate reaches the scan).
    """
    if df.isStreaming and ts in df.columns:
        return F.when(F.hash(F.col(ts)) >= F.lit(-(2**31)), value)
    return value


def route(df: DataFrame, event_type: str) -> DataFrame:
    """Keep one event type; a null type never matches."""
    kind = F.col("eventType")
    if df.isStreaming:
        # coalesced: no "eventType is not null" can be inferred and pushed below the watermark
        kind = F.coalesce(kind, F.lit(""))
    return df.filter(kind == event_time_gate(df, F.lit(event_type)))


def page_views(df: DataFrame) -> DataFrame:
    return route(df, schemas.PAGE_VIEW)


def add_to_carts(df: DataFrame) -> DataFrame:
    return route(df, schemas.ADD_TO_CART)


def checkouts(df: DataFrame) -> DataFrame:
    return route(df, schemas.CHECKOUT)


def event_refs(df: DataFrame) -> DataFrame:
    """Per routed event, its reference id: user, product or transaction."""
    t = F.col("eventType")
    ref = (F.when(t == schemas.PAGE_VIEW, F.col("userId"))
           .when(t == schemas.ADD_TO_CART, F.col("productId"))
           .when(t == schemas.CHECKOUT, F.col("transactionId")))
    return (df.filter(t.isin(schemas.PAGE_VIEW, schemas.ADD_TO_CART, schemas.CHECKOUT))
              .select("eventId", F.col("eventType").alias("event_type"), ref.alias("ref_id")))


def sale_amount() -> Column:
    """totalAmount, else price × quantity when both are set, else 0."""
    return F.coalesce(F.col("totalAmount"),
                      F.col("productPrice") * F.col("productQuantity"),
                      F.lit(0.0))


def product_sales(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Add-to-cart events as (event_ts, product_id, amount)."""
    return add_to_carts(df).select(
        "eventId", F.col(ts).alias("event_ts"),
        F.coalesce(F.col("productId"), F.lit("unknown")).alias("product_id"),
        sale_amount().alias("amount"))


def message_key() -> Column:
    """Kafka message key: first non-empty of userId, cartId, eventId."""
    return F.coalesce(F.nullif(F.col("userId"), F.lit("")),
                      F.nullif(F.col("cartId"), F.lit("")),
                      F.col("eventId"))


def event_messages(df: DataFrame) -> DataFrame:
    """Events as Kafka messages ``(key, value)``: compact JSON, nulls omitted."""
    return df.select(message_key().alias("key"), encode_events(df).alias("value"))


def active_users_label(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("active_users_5m="), F.col("users").cast("string")).alias("label"))


def top_n_label(nested: DataFrame) -> DataFrame:
    size = F.coalesce(F.size(F.col("top_n")), F.lit(0))
    size = F.when(F.col("top_n").isNull(), F.lit(0)).otherwise(size)
    return nested.select(F.concat(F.lit("topN_hour_key="), F.col("hour_key"),
                                  F.lit(", size="), size.cast("string")).alias("label"))


def abandoned_label(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("abandoned_cart="), F.col("cart_id")).alias("label"))
