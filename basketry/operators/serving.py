"""Serving reads over the result tables.

Each read is a small DataFrame; absent data gives the reference's
defaults (0, an empty list, 0).  Top-N reads by hour filter on the hour key,
which prunes to one partition when the table is stored by ``hour_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def current_active_users(au: DataFrame) -> DataFrame:
    """Latest window's active users; always one row, 0 when empty."""
    return au.agg(F.coalesce(F.max_by("users", "minute_ts"), F.lit(0)).cast("bigint")
                  .alias("active_users_5m"))


def hour_key(ts_col: str = "hour_ts"):
    return F.date_format(F.col(ts_col), "yyyyMMddHH")


def top_products_for_hour(top: DataFrame, hour: str | None = None) -> DataFrame:
    """Items of one hour (UTC ``yyyyMMddHH``; default: the current hour),
    highest amount first, equal amounts in descending product id.
    ``position`` carries that order (1 = first).
    """
    h = F.lit(hour) if hour else F.date_format(F.current_timestamp(), "yyyyMMddHH")
    key = F.col("hour_key") if "hour_key" in top.columns else hour_key()
    one = top.filter(key == h).select(h.alias("hour"), "product_id", "amount")
    w = Window.partitionBy("hour").orderBy(F.desc("amount"), F.desc("product_id"))
    return one.withColumn("position", F.row_number().over(w).cast("bigint"))


def events_of_hour(events: DataFrame, hour: str, ts: str = "event_ts") -> DataFrame:
    """Events of one UTC hour ``yyyyMMddHH``: a range of the event time, which
    reaches the scan of a table that stores it."""
    start = F.to_timestamp(F.lit(hour), "yyyyMMddHH")
    return events.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 HOUR")))


def latest_active_users(au: DataFrame, n: int = 5) -> DataFrame:
    return au.orderBy(F.desc("minute_ts")).limit(n)


def latest_top_products(top: DataFrame, n: int = 20) -> DataFrame:
    return (top.select("hour_ts", "product_id", "amount")
               .orderBy(F.desc("hour_ts"), F.desc("amount"), F.asc("product_id")).limit(n))


def search_top_products(docs_or_rows: DataFrame, n: int = 10) -> DataFrame:
    return (docs_or_rows.select("hour_ts", "product_id", "amount")
                        .orderBy(F.desc("hour_ts"), F.desc("amount"), F.asc("product_id"))
                        .limit(n))


def table_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# --- reads over a deployment's stored results --------------------------------
# ``out`` is a ``basketry.streaming.jobs.Outputs``; each read is a small query
# over the keyed tables the streaming jobs maintain.

def metrics_active_users(spark, out) -> DataFrame:
    """Current 5-minute active users (0 when nothing was written yet): one stored row."""
    slot = out.active_users_slot().read(spark)
    return slot.agg(F.coalesce(F.max_by("value", "ts"), F.lit(0)).cast("bigint").alias("active_users_5m"))


def metrics_top_products_hourly(spark, out, hour: str | None = None) -> DataFrame:
    """Top products of one UTC hour ``yyyyMMddHH`` (default: now); the hour
    filter prunes the store to that hour's partition."""
    return top_products_for_hour(out.top_products().read(spark), hour)


def metrics_abandoned_count(spark, out) -> DataFrame:
    """Number of abandoned carts: the sum of the batches' counts."""
    return out.abandoned().count(spark).withColumnRenamed("n", "abandoned_carts_count")
