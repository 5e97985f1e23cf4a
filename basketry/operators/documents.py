"""Search-document shapes: (index, id, doc JSON) per result row.

The writer sends them with the deployment's connector; ids are stable so a
replay overwrites the same documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.timeparse import to_epoch_ms

_KEEP_NULLS = {"ignoreNullFields": "false"}


def transaction_docs(tx: DataFrame) -> DataFrame:
    """Index ``transactions``: camelCase bean fields, date as epoch ms."""
    fields = []
    for n, _ in schemas.TRANSACTION_FIELDS:
        c = F.col(schemas.snake(n))
        if n == "transactionDate":
            c = to_epoch_ms(c.cast("timestamp"))
        fields.append(c.alias(n))
    return tx.select(F.lit("transactions").alias("index"),
                     F.col("transaction_id").alias("id"),
                     F.to_json(F.struct(*fields), _KEEP_NULLS).alias("doc"))


def active_user_docs(au: DataFrame) -> DataFrame:
    ms = to_epoch_ms(F.col("minute_ts").cast("timestamp"))
    return au.select(F.lit("active_users_minute").alias("index"),
                     ms.cast("string").alias("id"),
                     F.to_json(F.struct(ms.alias("minute_ts"), F.col("users"))).alias("doc"))


def top_product_docs(tp: DataFrame) -> DataFrame:
    ms = to_epoch_ms(F.col("hour_ts").cast("timestamp"))
    return tp.select(F.lit("top_products_hourly").alias("index"),
                     F.concat_ws(":", ms.cast("string"), F.col("product_id")).alias("id"),
                     F.to_json(F.struct(ms.alias("hour_ts"), F.col("product_id"),
                                        F.col("amount"))).alias("doc"))
