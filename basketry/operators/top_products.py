"""Top products per tumbling window by add-to-cart amount.

* ``product_sales_windowed``: sum per (window, product) — partial hash
  aggregation before the shuffle, so a hot product costs one row per task.
* ``top_n``: ``row_number() <= n`` per window.  Spark plans this with a
  partial ``WindowGroupLimit`` *before* the shuffle, so each task forwards at
  most n rows per window: a window with millions of products does not
  gather them into one task.
* ``nest_top_n`` / ``flatten_top_n``: the nested per-hour result
  ``{hour_key, window_start_ms, top_n[]}`` and its flattening back to rows.

Ties at the cut are broken by product id ascending (the reference leaves
them unspecified).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.money import money_sum
from basketry.operators.events import product_sales

HOUR = "1 hour"
TOP_N = 10


def product_sales_windowed(events: DataFrame, window: str = HOUR, ts: str = "event_ts",
                           from_sales: bool = False) -> DataFrame:
    """(hour_ts = window start, product_id, amount) per non-empty window."""
    sales = events if from_sales else product_sales(events, ts)
    sales = sales.filter(F.col("product_id").isNotNull() & F.col("amount").isNotNull())
    return (sales.groupBy(F.window("event_ts", window).alias("w"), "product_id")
                 .agg(money_sum("amount").alias("amount"))
                 .select(F.col("w.start").alias("hour_ts"), "product_id", "amount"))


def top_n(windowed: DataFrame, n: int = TOP_N, period: str = "hour_ts") -> DataFrame:
    w = Window.partitionBy(period).orderBy(F.desc("amount"), F.asc("product_id"))
    return (windowed.withColumn("product_rank", F.row_number().over(w))
                    .filter(F.col("product_rank") <= n)
                    .withColumn("product_rank", F.col("product_rank").cast("bigint")))


def top_products(events: DataFrame, n: int = TOP_N, window: str = HOUR,
                 ts: str = "event_ts") -> DataFrame:
    return top_n(product_sales_windowed(events, window, ts), n)


def nest_top_n(top: DataFrame, period: str = "hour_ts") -> DataFrame:
    """One row per window: hour key (UTC yyyyMMddHH), start ms, ordered list.

    The list per window holds at most n entries (input is already cut).
    """
    items = F.sort_array(F.collect_list(F.struct("product_rank", "product_id", "amount")))
    return (top.groupBy(period).agg(items.alias("items"))
               .select(F.date_format(period, "yyyyMMddHH").alias("hour_key"),
                       F.unix_millis(F.col(period)).alias("window_start_ms"),
                       F.transform("items", lambda x: F.struct(
                           x["product_id"].alias("product_id"),
                           x["amount"].alias("amount"))).alias("top_n")))


def flatten_top_n(nested: DataFrame) -> DataFrame:
    """Nested result -> (hour_ts, product_id, amount), skipping null entries."""
    return (nested.select(F.timestamp_millis("window_start_ms").alias("hour_ts"),
                          F.explode("top_n").alias("t"))
                  .filter(F.col("t").isNotNull()
                          & F.col("t.product_id").isNotNull()
                          & F.col("t.amount").isNotNull())
                  .select("hour_ts", F.col("t.product_id").alias("product_id"),
                          F.col("t.amount").alias("amount")))
