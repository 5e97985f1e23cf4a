"""Adapters from the driver's tables to the two input contracts.

* ``events_envelope``: the ``events`` table as shop events (one wide record
  per event, fields that do not apply are null).
* ``transactions``: ``lineitem ⋈ orders ⋈ part`` as transaction records.

Both are pure projections/joins, so Catalyst prunes the scans to the columns
used and pushes filters from the metric functions into the parquet reads.
The SQL twins in ``basketry.plans.oracle`` compute the same rows in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.sources.tables import read_table

# Value domains of the shop events (producer contract).
CATEGORIES = ["electronic", "fashion", "grocery", "home", "beauty", "sports"]
PAGES = ["/home", "/plp", "/pdp", "/cart", "/checkout"]
REFERRERS = ["direct", "email", "ads", "social"]
PAYMENT_METHODS = ["credit_card", "debit_card", "online_transfer"]
CURRENCIES = ["USD", "GBP"]

# Mapping of the driver's event types onto shop event types.
EVENT_TYPE_MAP = {"view": "page_view", "click": "add_to_cart", "purchase": "checkout"}


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] with a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def envelope_from_events(ev: DataFrame) -> DataFrame:
    """Typed envelope (+ ``event_ts`` timestamp, + ISO ``timestamp`` text)."""
    # the product index is read from the JSON props once per row
    ev = ev.select("*", F.get_json_object("props", "$.k").cast("int").alias("_k"))
    et = F.col("event_type")
    eid = F.col("event_id")
    k = F.col("_k")
    is_cart = et.isin("click", "purchase")
    has_product = (et == "click") | ((et == "purchase") & (eid % 2 == 0))
    # one CASE: Catalyst folds "eventType = x" into its branches, so route
    # filters become predicates on the raw column
    mapped = et
    items = list(EVENT_TYPE_MAP.items())
    case = F.when(et == items[0][0], F.lit(items[0][1]))
    for src, dst in items[1:]:
        case = case.when(et == src, F.lit(dst))
    mapped = case.otherwise(et)
    cols = {
        "eventId": eid.cast("string"),
        "eventType": mapped,
        "timestamp": F.date_format(F.col("ts").cast("timestamp"),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        "userId": F.col("user_id").cast("string"),
        "sessionId": F.concat(F.lit("s"), eid.cast("string")),
        "cartId": F.when(is_cart, F.concat(F.lit("c"), (F.col("user_id") % 10).cast("string"))),
        "currency": F.when(is_cart, _pick(CURRENCIES, eid % 2)),
        "productId": F.when(has_product & (k % 10 != 0), F.concat(F.lit("p"), k.cast("string"))),
        "productName": F.when(has_product, F.concat(F.lit("product"), k.cast("string"))),
        "productCategory": F.when(has_product, _pick(CATEGORIES, k % 6)),
        "productBrand": F.when(has_product, F.concat(F.lit("brand"), (k % 5).cast("string"))),
        "productPrice": F.when(has_product, F.col("value")),
        "productQuantity": F.when(has_product, (k % 5 + 1).cast("int")),
        "totalAmount": F.when(is_cart & (eid % 3 != 0), F.col("value")),
        "transactionId": F.when(et == "purchase", F.concat(F.lit("t"), eid.cast("string"))),
        "paymentMethod": F.when(et == "purchase", _pick(PAYMENT_METHODS, eid % 3)),
        "page": F.when(et == "view", _pick(PAGES, eid % 5)),
        "referrer": F.when(et == "view", _pick(REFERRERS, eid % 4)),
    }
    return ev.select(*[c.alias(n) for n, c in cols.items()],
                     F.col("ts").cast("timestamp").alias("event_ts"))


def events_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return envelope_from_events(ev)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction records (snake_case table form) from the TPC-H tables.

    Two equi-joins; Catalyst/AQE choose broadcast only when a side's
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``,
    else sort-merge with skew splitting.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    p = read_table(spark, sf_dir, "part",
                   ["p_partkey", "p_name", "p_type", "p_brand", "p_retailprice"])
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey))
    cols = {
        "transaction_id": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                   F.col("l_linenumber").cast("string")),
        "product_id": F.col("l_partkey").cast("string"),
        "product_name": F.col("p_name"),
        "product_category": F.col("p_type"),
        "product_price": F.col("p_retailprice"),
        "product_quantity": F.col("l_quantity").cast("int"),
        "product_brand": F.col("p_brand"),
        "total_amount": F.col("l_extendedprice"),
        "currency": _pick(CURRENCIES, F.col("o_orderkey") % 2),
        "customer_id": F.col("o_custkey").cast("string"),
        "transaction_date": F.col("l_shipdate"),
        "payment_method": _pick(PAYMENT_METHODS, F.col("o_orderkey") % 3),
    }
    return j.select(*[c.alias(n) for n, c in cols.items()])
