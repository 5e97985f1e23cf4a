"""DuckDB oracle SQL for the registered queries.

Each oracle is written independently of the Spark plan where the two can
differ: sliding windows via ``generate_series``, abandoned carts via the
``lead()`` formulation, roll-ups via plain GROUP BY.  Views ``events``,
``lineitem``, ``orders``, ``part`` … are registered by the caller.
"""

from __future__ import annotations

SERVE_HOUR = "2024011512"
AS_OF = "2024-01-15 00:00:00"

# Common table expressions, in dependency order.
CTES: dict[str, str] = {}

CTES["events_base"] = """
SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       event_type IN ('click', 'purchase') AS is_cart,
       (event_type = 'click' OR (event_type = 'purchase' AND event_id % 2 = 0)) AS has_product
FROM events"""

CTES["events_env"] = """
SELECT CAST(event_id AS VARCHAR) AS "eventId",
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                  WHEN 'purchase' THEN 'checkout' ELSE event_type END AS "eventType",
  CAST(user_id AS VARCHAR) AS "userId",
  's' || CAST(event_id AS VARCHAR) AS "sessionId",
  CASE WHEN is_cart THEN 'c' || CAST(user_id % 10 AS VARCHAR) END AS "cartId",
  CASE WHEN is_cart THEN ['USD', 'GBP'][event_id % 2 + 1] END AS "currency",
  CASE WHEN has_product AND k % 10 <> 0 THEN 'p' || CAST(k AS VARCHAR) END AS "productId",
  CASE WHEN has_product THEN 'product' || CAST(k AS VARCHAR) END AS "productName",
  CASE WHEN has_product THEN ['electronic', 'fashion', 'grocery', 'home', 'beauty', 'sports'][k % 6 + 1] END
    AS "productCategory",
  CASE WHEN has_product THEN 'brand' || CAST(k % 5 AS VARCHAR) END AS "productBrand",
  CASE WHEN has_product THEN value END AS "productPrice",
  CASE WHEN has_product THEN CAST(k % 5 + 1 AS INTEGER) END AS "productQuantity",
  CASE WHEN is_cart AND event_id % 3 <> 0 THEN value END AS "totalAmount",
  CASE WHEN event_type = 'purchase' THEN 't' || CAST(event_id AS VARCHAR) END AS "transactionId",
  CASE WHEN event_type = 'purchase' THEN ['credit_card', 'debit_card', 'online_transfer'][event_id % 3 + 1] END
    AS "paymentMethod",
  CASE WHEN event_type = 'view' THEN ['/home', '/plp', '/pdp', '/cart', '/checkout'][event_id % 5 + 1] END AS "page",
  CASE WHEN event_type = 'view' THEN ['direct', 'email', 'ads', 'social'][event_id % 4 + 1] END AS "referrer",
  ts AS event_ts,
  event_id
FROM events_base"""

CTES["product_sales"] = """
SELECT "eventId", event_ts, coalesce("productId", 'unknown') AS product_id,
       coalesce("totalAmount", "productPrice" * "productQuantity", 0.0) AS amount
FROM events_env WHERE "eventType" = 'add_to_cart'"""

CTES["hourly"] = """
SELECT date_trunc('hour', event_ts) AS hour_ts, product_id,
       CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) AS amount
FROM product_sales GROUP BY ALL"""

CTES["daily"] = """
SELECT date_trunc('day', event_ts) AS hour_ts, product_id,
       CAST(sum(CAST(amount AS DECIMAL(28,8))) AS DOUBLE) AS amount
FROM product_sales GROUP BY ALL"""

CTES["ranked"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY hour_ts ORDER BY amount DESC, product_id ASC) AS BIGINT)
       AS product_rank
FROM hourly"""

CTES["top10"] = "SELECT * FROM ranked WHERE product_rank <= 10"

CTES["active"] = """
SELECT minute_ts, count(DISTINCT "userId") AS users FROM (
  SELECT unnest(generate_series(m + INTERVAL 1 MINUTE, m + INTERVAL 5 MINUTE, INTERVAL 1 MINUTE))
         AS minute_ts, "userId"
  FROM (SELECT DISTINCT date_trunc('minute', event_ts) AS m, "userId"
        FROM events_env WHERE "eventType" = 'page_view'))
GROUP BY minute_ts"""

CTES["cart_events"] = """
SELECT "cartId" AS cart_id, event_ts AS ts,
       CASE WHEN "eventType" = 'checkout' THEN 1 ELSE 0 END AS is_checkout
FROM events_env
WHERE "cartId" IS NOT NULL AND "eventType" IN ('add_to_cart', 'checkout')"""

CTES["cart_next"] = """
SELECT cart_id, ts, is_checkout,
       lead(ts) OVER (PARTITION BY cart_id ORDER BY ts, is_checkout) AS next_ts
FROM cart_events"""

CTES["abandoned"] = """
SELECT cart_id, ts + INTERVAL 30 MINUTE AS abandoned_at FROM cart_next
WHERE is_checkout = 0 AND (next_ts IS NULL OR next_ts > ts + INTERVAL 30 MINUTE)"""

CTES["tx"] = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
  CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS product_category,
  p_retailprice AS product_price, CAST(l_quantity AS INTEGER) AS product_quantity,
  p_brand AS product_brand, l_extendedprice AS total_amount,
  ['USD', 'GBP'][o_orderkey % 2 + 1] AS currency, CAST(o_custkey AS VARCHAR) AS customer_id,
  l_shipdate AS transaction_date,
  ['credit_card', 'debit_card', 'online_transfer'][o_orderkey % 3 + 1] AS payment_method
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

CTES["tx_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date DESC,
         product_id DESC, total_amount DESC, product_quantity DESC) AS rn FROM tx)
WHERE rn = 1"""

CTES["cat_daily"] = """
SELECT CAST(transaction_date AS DATE) AS transaction_date, product_category AS category,
       sum(CAST(total_amount AS DECIMAL(28,8))) AS total
FROM tx WHERE product_category IS NOT NULL GROUP BY ALL"""

CTES["monthly"] = """
SELECT CAST(year(transaction_date) AS INTEGER) AS "year",
       CAST(month(transaction_date) AS INTEGER) AS "month",
       sum(CAST(total_amount AS DECIMAL(28,8))) AS total
FROM tx GROUP BY ALL"""

_DEPS = {
    "events_env": ["events_base"],
    "product_sales": ["events_env"],
    "hourly": ["product_sales"],
    "daily": ["product_sales"],
    "ranked": ["hourly"],
    "top10": ["ranked"],
    "active": ["events_env"],
    "cart_events": ["events_env"],
    "cart_next": ["cart_events"],
    "abandoned": ["cart_next"],
    "tx_latest": ["tx"],
    "cat_daily": ["tx"],
    "monthly": ["tx"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()

    def visit(n):
        if n in need:
            return
        need.add(n)
        for d in _DEPS.get(n, []):
            visit(d)

    for n in names:
        visit(n)
    return [n for n in CTES if n in need]


def sql(body: str, *ctes: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named shared CTEs (and their dependencies),
    then any query-specific ``extra`` CTEs."""
    parts = [f"{n} AS ({CTES[n]}\n)" for n in _closure(list(ctes))]
    parts += [f"{n} AS ({q}\n)" for n, q in (extra or {}).items()]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


ENVELOPE_COLS = ", ".join(f'"{c}"' for c in [
    "eventId", "eventType", "userId", "sessionId", "cartId", "currency", "productId",
    "productName", "productCategory", "productBrand", "productPrice", "productQuantity",
    "totalAmount", "transactionId", "paymentMethod", "page", "referrer"]) + ", event_ts"

_KEYED_USER = """CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL ELSE "userId" END"""
_MESSAGE_KEY = f"""coalesce(nullif({_KEYED_USER}, ''), nullif("cartId", ''), "eventId")"""

ORACLE: dict[str, str] = {
    "route_page_views": sql(f"""SELECT {ENVELOPE_COLS} FROM events_env WHERE "eventType" = 'page_view'""",
                            "events_env"),
    "route_add_to_cart": sql(f"""SELECT {ENVELOPE_COLS} FROM events_env WHERE "eventType" = 'add_to_cart'""",
                             "events_env"),
    "route_checkout": sql(f"""SELECT {ENVELOPE_COLS} FROM events_env WHERE "eventType" = 'checkout'""",
                          "events_env"),
    "event_refs": sql("""
        SELECT "eventId", "eventType" AS event_type,
               CASE "eventType" WHEN 'page_view' THEN "userId" WHEN 'add_to_cart' THEN "productId"
                                ELSE "transactionId" END AS ref_id
        FROM events_env WHERE "eventType" IN ('page_view', 'add_to_cart', 'checkout')""", "events_env"),
    "product_sales": sql("SELECT * FROM product_sales", "product_sales"),
    "event_message_key": sql(f"""SELECT "eventId", {_MESSAGE_KEY} AS key FROM events_env""", "events_env"),
    "event_time": """
        SELECT CAST(event_id AS VARCHAR) AS "eventId",
               CASE WHEN event_id % 8 IN (0, 1, 2) THEN date_trunc('millisecond', ts)
                    WHEN event_id % 8 = 3 THEN date_trunc('minute', ts)
                    ELSE date_trunc('second', ts) END AS event_ts
        FROM events""",
    "decode_events": sql(f"""
        SELECT * REPLACE (date_trunc('millisecond', event_ts) AS event_ts)
        FROM (SELECT {ENVELOPE_COLS} FROM events_env)""", "events_env"),
    "quarantine_events": """
        SELECT CASE event_id % 50 WHEN 0 THEN 'malformed' WHEN 1 THEN 'unknown_field'
                                  WHEN 2 THEN 'bad_type' ELSE 'ok' END AS reason,
               count(*) AS n_rows
        FROM events GROUP BY 1""",
    "quarantine_transactions": sql("""
        SELECT reason, count(*) AS n_rows, CASE WHEN reason = 'ok' THEN
               CAST(sum(CAST(total_amount + 0.001 AS DECIMAL(28,8))) AS DOUBLE) END AS total
        FROM (SELECT *, CASE CAST(split_part(transaction_id, '-', 1) AS BIGINT) % 40
                        WHEN 0 THEN 'malformed' WHEN 1 THEN 'unknown_field' WHEN 2 THEN 'bad_type'
                        WHEN 3 THEN 'null_key' WHEN 4 THEN 'null_key' ELSE 'ok' END AS reason FROM tx)
        GROUP BY reason""", "tx"),
    "decode_transactions": sql("SELECT * FROM tx", "tx"),
    "event_messages": sql(f"""
        SELECT {_MESSAGE_KEY} AS key, "eventId", "eventType", {_KEYED_USER} AS "userId", "cartId",
               "productId", "productQuantity", "totalAmount", date_trunc('millisecond', event_ts) AS event_ts
        FROM events_env""", "events_env"),
    "active_users_5m": sql("SELECT minute_ts, users FROM active", "active"),
    "latest_active_users": sql("SELECT minute_ts, users FROM active ORDER BY minute_ts DESC LIMIT 5", "active"),
    "active_users_rows": sql("SELECT count(*) AS n_rows FROM active", "active"),
    "serve_active_users": sql("SELECT coalesce(arg_max(users, minute_ts), 0) AS active_users_5m FROM active",
                              "active"),
    "product_sales_hourly": sql("SELECT hour_ts, product_id, amount FROM hourly", "hourly"),
    "top_products_hourly": sql("SELECT hour_ts, product_id, amount, product_rank FROM top10", "top10"),
    "top_products_hourly_n2": sql(
        "SELECT hour_ts, product_id, amount, product_rank FROM ranked WHERE product_rank <= 2", "ranked"),
    "top_products_daily": sql("""
        SELECT * FROM (
          SELECT hour_ts, product_id, amount,
                 CAST(row_number() OVER (PARTITION BY hour_ts ORDER BY amount DESC, product_id) AS BIGINT)
                   AS product_rank
          FROM daily) WHERE product_rank <= 10""", "daily"),
    "top_products_nested": sql("""
        SELECT strftime(hour_ts, '%Y%m%d%H') AS hour_key, epoch_ms(hour_ts) AS window_start_ms,
               count(*) AS n_items,
               string_agg(product_id, ',' ORDER BY product_rank) AS top_n_ids,
               arg_min(product_id, product_rank) AS first_product_id,
               arg_min(amount, product_rank) AS first_amount
        FROM top10 GROUP BY hour_ts""", "top10"),
    "top_products_flatten": sql("SELECT hour_ts, product_id, amount FROM top10", "top10"),
    "metric_labels": sql("""
        SELECT 'active_users_5m=' || CAST(users AS VARCHAR) AS label FROM active
        UNION ALL
        SELECT 'topN_hour_key=' || strftime(hour_ts, '%Y%m%d%H') || ', size=' || CAST(count(*) AS VARCHAR)
        FROM top10 GROUP BY hour_ts
        UNION ALL
        SELECT 'abandoned_cart=' || cart_id FROM abandoned""", "active", "top10", "abandoned"),
    "latest_top_products": sql("""
        SELECT hour_ts, product_id, amount FROM top10
        ORDER BY hour_ts DESC, amount DESC, product_id ASC LIMIT 20""", "top10"),
    "search_top_products": sql("""
        SELECT hour_ts, product_id, amount FROM top10
        ORDER BY hour_ts DESC, amount DESC, product_id ASC LIMIT 10""", "top10"),
    "serve_top_products": sql(f"""
        SELECT '{SERVE_HOUR}' AS hour, product_id, amount,
               row_number() OVER (ORDER BY amount DESC, product_id DESC) AS position
        FROM top10 WHERE strftime(hour_ts, '%Y%m%d%H') = '{SERVE_HOUR}'""", "top10"),
    "abandoned_carts": sql("SELECT cart_id, abandoned_at FROM abandoned", "abandoned"),
    "abandoned_carts_6h": sql("""
        SELECT cart_id, ts + INTERVAL 6 HOUR AS abandoned_at FROM cart_next
        WHERE is_checkout = 0 AND (next_ts IS NULL OR next_ts > ts + INTERVAL 6 HOUR)""", "cart_next"),
    "abandoned_carts_asof": sql(f"""
        SELECT cart_id, abandoned_at FROM abandoned
        WHERE abandoned_at <= TIMESTAMP '{AS_OF}'""", "abandoned"),
    "abandoned_carts_count": sql("SELECT count(*) AS abandoned_carts_count FROM abandoned", "abandoned"),
    "abandoned_carts_recent": sql("""
        SELECT cart_id, abandoned_at FROM abandoned
        ORDER BY abandoned_at DESC, cart_id DESC LIMIT 20""", "abandoned"),
    "transactions_latest": sql("SELECT * FROM tx_latest", "tx_latest"),
    "sales_per_category": sql("""
        SELECT transaction_date, category, CAST(total AS DOUBLE) AS total_sales FROM cat_daily""", "cat_daily"),
    "sales_per_category_running": sql("""
        SELECT transaction_date, category,
               CAST(sum(total) OVER (PARTITION BY category ORDER BY transaction_date
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS total_sales
        FROM cat_daily""", "cat_daily"),
    "sales_per_day": sql("""
        SELECT CAST(transaction_date AS DATE) AS transaction_date,
               CAST(sum(CAST(total_amount AS DECIMAL(28,8))) AS DOUBLE) AS total_sales
        FROM tx GROUP BY 1""", "tx"),
    "sales_per_month": sql("""SELECT "year", "month", CAST(total AS DOUBLE) AS total_sales FROM monthly""", "monthly"),
    "sales_per_month_running": sql("""
        SELECT "year", "month", min("year") OVER (PARTITION BY "month") AS stored_year,
               CAST(sum(total) OVER (PARTITION BY "month" ORDER BY "year"
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS total_sales
        FROM monthly""", "monthly"),
    "doc_transactions": sql("""
        SELECT 'transactions' AS doc_index, transaction_id AS id, transaction_id, product_id,
               product_quantity, total_amount, customer_id,
               epoch_ms(transaction_date) AS transaction_date_ms, payment_method
        FROM tx_latest""", "tx_latest"),
    "doc_active_users": sql("""
        SELECT 'active_users_minute' AS doc_index, CAST(epoch_ms(minute_ts) AS VARCHAR) AS id,
               epoch_ms(minute_ts) AS minute_ts_ms, users
        FROM active""", "active"),
    "doc_top_products": sql("""
        SELECT 'top_products_hourly' AS doc_index,
               CAST(epoch_ms(hour_ts) AS VARCHAR) || ':' || product_id AS id,
               epoch_ms(hour_ts) AS hour_ts_ms, product_id, amount
        FROM top10""", "top10"),
}
