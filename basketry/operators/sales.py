"""Transactions: last-write-wins table and sales roll-ups.

Roll-ups read the raw transaction stream (a transaction delivered twice
counts twice, as in the reference); ``dedupe=True`` rolls up the
last-write-wins table instead.  Roll-ups are keyed by the event date of the
transaction, so a replay gives the same answer.

Sums are exact decimals (``functions.money``).  Running totals run over the small daily
(or monthly) summary, never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.money import money_parts, money_sum, money_total, running_parts

#: Last-write order of duplicate ids in a stored table (a stream has the order of arrival).
TX_LAST_WRITE_ORDER = ["transaction_date", "product_id", "total_amount", "product_quantity"]


def latest_transactions(tx: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Keyed last-write-wins by transaction_id.

    ``order``: columns whose descending order puts the last write first
    (in a stream: the offset or arrival sequence).  ``row_number() = 1`` is
    planned with a partial WindowGroupLimit before the shuffle, so an id
    repeated millions of times forwards one row per task.
    """
    order = order or TX_LAST_WRITE_ORDER
    w = Window.partitionBy("transaction_id").orderBy(*[F.desc(c) for c in order])
    return (tx.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def _base(tx: DataFrame, dedupe: bool) -> DataFrame:
    return latest_transactions(tx) if dedupe else tx


def null_key(tx: DataFrame):
    """Does a record lack a key of the result tables (id, category or date)?"""
    return (F.col("transaction_id").isNull() | F.col("product_category").isNull()
            | F.col("transaction_date").isNull())


def null_key_rows(tx: DataFrame) -> DataFrame:
    """Transactions that cannot be keyed (the job dead-letters them)."""
    return tx.filter(null_key(tx))


def _daily_category_parts(tx: DataFrame) -> DataFrame:
    return (tx.filter(F.col("product_category").isNotNull())
              .groupBy(F.to_date("transaction_date").alias("transaction_date"),
                       F.col("product_category").alias("category"))
              .agg(*money_parts("total_amount")))


def sales_per_category(tx: DataFrame, dedupe: bool = False) -> DataFrame:
    """(transaction_date, category, total_sales) per event date and category."""
    return (_base(tx, dedupe).filter(F.col("product_category").isNotNull())
            .groupBy(F.to_date("transaction_date").alias("transaction_date"),
                     F.col("product_category").alias("category"))
            .agg(money_sum("total_amount").alias("total_sales")))


def sales_per_category_running(tx: DataFrame, dedupe: bool = False) -> DataFrame:
    """Running total per category as of each date (the keyed running reduce)."""
    d = _daily_category_parts(_base(tx, dedupe))
    w = (Window.partitionBy("category").orderBy("transaction_date")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (d.select("transaction_date", "category", *running_parts(w))
             .select("transaction_date", "category", money_total().alias("total_sales")))


def sales_per_day(tx: DataFrame, dedupe: bool = False) -> DataFrame:
    return (_base(tx, dedupe)
            .groupBy(F.to_date("transaction_date").alias("transaction_date"))
            .agg(money_sum("total_amount").alias("total_sales")))


def _monthly_parts(tx: DataFrame) -> DataFrame:
    return (tx.groupBy(F.year("transaction_date").alias("year"),
                       F.month("transaction_date").alias("month"))
              .agg(*money_parts("total_amount")))


def sales_per_month(tx: DataFrame, dedupe: bool = False) -> DataFrame:
    return (_base(tx, dedupe)
            .groupBy(F.year("transaction_date").alias("year"),
                     F.month("transaction_date").alias("month"))
            .agg(money_sum("total_amount").alias("total_sales")))


def sales_per_month_running(tx: DataFrame, dedupe: bool = False) -> DataFrame:
    """The reference's literal reading: the reduce is keyed by month number
    only and keeps the year of the first record.  Per (year, month): the
    running total of that month number across years, and the stored year.
    """
    m = _monthly_parts(_base(tx, dedupe))
    running = (Window.partitionBy("month").orderBy("year")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (m.select("year", "month",
                     F.min("year").over(Window.partitionBy("month")).alias("stored_year"),
                     *running_parts(running))
             .select("year", "month", "stored_year", money_total().alias("total_sales")))
