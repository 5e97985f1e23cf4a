"""Input contracts, result schemas and table DDL.

Schemas are fixed and compiled here; nothing is inferred at run time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names and types of the shop event envelope, in the
# order the producer and consumer agree on.  One wide record for every event
# type; fields that do not apply are absent (null).
# ---------------------------------------------------------------------------
EVENT_FIELDS: list[tuple[str, str]] = [
    ("eventId", "string"),
    ("eventType", "string"),
    ("timestamp", "string"),
    ("userId", "string"),
    ("sessionId", "string"),
    ("cartId", "string"),
    ("currency", "string"),
    ("productId", "string"),
    ("productName", "string"),
    ("productCategory", "string"),
    ("productBrand", "string"),
    ("productPrice", "double"),
    ("productQuantity", "int"),
    ("totalAmount", "double"),
    ("transactionId", "string"),
    ("paymentMethod", "string"),
    ("page", "string"),
    ("referrer", "string"),
]

# The transaction record (camelCase on the wire).
TRANSACTION_FIELDS: list[tuple[str, str]] = [
    ("transactionId", "string"),
    ("productId", "string"),
    ("productName", "string"),
    ("productCategory", "string"),
    ("productPrice", "double"),
    ("productQuantity", "int"),
    ("productBrand", "string"),
    ("totalAmount", "double"),
    ("currency", "string"),
    ("customerId", "string"),
    ("transactionDate", "timestamp"),
    ("paymentMethod", "string"),
]

# Event type names.
PAGE_VIEW = "page_view"
ADD_TO_CART = "add_to_cart"
CHECKOUT = "checkout"

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def struct_of(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


EVENT_SCHEMA = struct_of(EVENT_FIELDS)
TRANSACTION_SCHEMA = struct_of(TRANSACTION_FIELDS)


def snake(name: str) -> str:
    out = []
    for ch in name:
        if ch.isupper():
            out.append("_")
            out.append(ch.lower())
        else:
            out.append(ch)
    return "".join(out)


# Transaction table columns (snake_case), same order as the record.
TRANSACTION_COLUMNS = [snake(n) for n, _ in TRANSACTION_FIELDS]

# Typed event columns after decoding: the text `timestamp` is replaced by the
# derived event time `event_ts`.
EVENT_COLUMNS = [n for n, _ in EVENT_FIELDS if n != "timestamp"]

# ---------------------------------------------------------------------------
# Result schemas
# ---------------------------------------------------------------------------
ACTIVE_USERS_MINUTE = T.StructType([
    T.StructField("minute_ts", T.TimestampNTZType()),
    T.StructField("users", T.LongType()),
])
TOP_PRODUCTS_HOURLY = T.StructType([
    T.StructField("hour_ts", T.TimestampNTZType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])
TOP_N_ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])
ABANDONED_CARTS = T.StructType([
    T.StructField("cart_id", T.StringType()),
    T.StructField("abandoned_at", T.TimestampNTZType()),
])
QUARANTINE = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# ---------------------------------------------------------------------------
# Result-table DDL (PostgreSQL dialect) for the JDBC writer.
# Created once at start, not per record.
# ---------------------------------------------------------------------------
DDL = {
    "transactions": (
        "CREATE TABLE IF NOT EXISTS transactions ("
        "transaction_id VARCHAR(255) PRIMARY KEY, product_id VARCHAR(255), "
        "product_name VARCHAR(255), product_category VARCHAR(255), "
        "product_price DOUBLE PRECISION, product_quantity INTEGER, "
        "product_brand VARCHAR(255), total_amount DOUBLE PRECISION, "
        "currency VARCHAR(255), customer_id VARCHAR(255), "
        "transaction_date TIMESTAMP, payment_method VARCHAR(255))"
    ),
    "sales_per_category": (
        "CREATE TABLE IF NOT EXISTS sales_per_category ("
        "transaction_date DATE, category VARCHAR(255), total_sales DOUBLE PRECISION, "
        "PRIMARY KEY (transaction_date, category))"
    ),
    "sales_per_day": (
        "CREATE TABLE IF NOT EXISTS sales_per_day ("
        "transaction_date DATE PRIMARY KEY, total_sales DOUBLE PRECISION)"
    ),
    "sales_per_month": (
        "CREATE TABLE IF NOT EXISTS sales_per_month ("
        "year INTEGER, month INTEGER, total_sales DOUBLE PRECISION, "
        "PRIMARY KEY (year, month))"
    ),
    "active_users_minute": (
        "CREATE TABLE IF NOT EXISTS active_users_minute ("
        "minute_ts TIMESTAMP PRIMARY KEY, users BIGINT)"
    ),
    "top_products_hourly": (
        "CREATE TABLE IF NOT EXISTS top_products_hourly ("
        "hour_ts TIMESTAMP, product_id TEXT, amount DOUBLE PRECISION, "
        "PRIMARY KEY(hour_ts, product_id))"
    ),
}

# Primary keys of the keyed result tables (used by the upsert writers).
TABLE_KEYS = {
    "transactions": ["transaction_id"],
    "sales_per_category": ["transaction_date", "category"],
    "sales_per_day": ["transaction_date"],
    "sales_per_month": ["year", "month"],
    "active_users_minute": ["minute_ts"],
    "top_products_hourly": ["hour_ts", "product_id"],
}
