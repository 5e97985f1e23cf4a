"""Hand-made edge rows (FIXTURES.md §3)."""

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import codec
from basketry.functions.timeparse import event_time
from basketry.operators import active_users, carts, events, sales, serving, top_products
from tests.conftest import rows
from tests.helpers import as_naive, cart_event, events as mk, minutes

REC = dt.datetime(2030, 1, 1, 0, 0, 0)


def _parse(spark, texts):
    df = spark.createDataFrame([(t, REC) for t in texts], "t string, rec timestamp")
    return [r[0] for r in as_naive(df.select(event_time("t", "rec").alias("x"))).collect()]


def test_time_fallback(spark):
    got = _parse(spark, [None, "garbage", "2025-10-24", "2025-10-24T01:23:45.000",
                         "2025-10-24T25:00:00Z", "2025-10-24 01:23:45Z"])
    assert got == [REC] * 6


def test_time_accepted(spark):
    got = _parse(spark, ["2024-01-01T00:00:30Z", "2024-01-01T00:00:30+00:00",
                         "2024-01-01T01:23+02:00", "2024-01-01T00:00:30.123456+00:00",
                         "2024-01-01T02:00:30.5+02:00", "2024-01-01T00:00:30.123456789Z"])
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 30), dt.datetime(2024, 1, 1, 0, 0, 30),
                   dt.datetime(2023, 12, 31, 23, 23), dt.datetime(2024, 1, 1, 0, 0, 30, 123000),
                   dt.datetime(2024, 1, 1, 0, 0, 30, 500000),
                   dt.datetime(2024, 1, 1, 0, 0, 30, 123000)]


def test_amount_chain(spark):
    df = mk(spark, [
        {"eventId": "1", "eventType": "add_to_cart", "productPrice": 10.5, "productQuantity": 2,
         "event_ts": minutes(0)},
        {"eventId": "2", "eventType": "add_to_cart", "productPrice": 10.5, "event_ts": minutes(0)},
        {"eventId": "3", "eventType": "add_to_cart", "totalAmount": 7.0, "productPrice": 1.0,
         "productQuantity": 2, "event_ts": minutes(0), "productId": "p9"},
    ])
    got = rows(events.product_sales(df), "eventId", "product_id", "amount")
    assert got == [("1", "unknown", 21.0), ("2", "unknown", 0.0), ("3", "p9", 7.0)]


def _au(spark, evs):
    return rows(as_naive(active_users.active_users(mk(spark, evs))), "minute_ts", "users")


def test_null_user_only(spark):
    got = _au(spark, [{"eventId": "1", "eventType": "page_view", "event_ts": minutes(0.5)}])
    assert got == [(minutes(m), 0) for m in range(1, 6)]


def test_same_user_twice_and_edge(spark):
    evs = [{"eventId": "1", "eventType": "page_view", "userId": "u", "event_ts": minutes(0.5)},
           {"eventId": "2", "eventType": "page_view", "userId": "u", "event_ts": minutes(1.5)},
           {"eventId": "3", "eventType": "page_view", "userId": "v", "event_ts": minutes(5)}]
    got = dict(_au(spark, evs))
    assert got[minutes(2)] == 1          # windows holding both events of u
    assert got[minutes(5)] == 1          # v at exactly 00:05 is not in [00:00, 00:05)
    assert got[minutes(6)] == 2
    # batch form equals the plain window() form
    pv = mk(spark, evs)
    plain = active_users._active_users_windowed(pv, "5 minutes", "1 minute", "event_ts")
    assert rows(as_naive(plain)) == sorted(got.items())


def test_top_n_tie_and_serving_tie(spark):
    evs = [{"eventId": str(i), "eventType": "add_to_cart", "productId": p, "totalAmount": a,
            "event_ts": minutes(i)} for i, (p, a) in enumerate([("pB", 5.0), ("pA", 5.0), ("pC", 9.0)])]
    top = top_products.top_products(mk(spark, evs), n=2)
    assert rows(top, "product_id", "product_rank") == [("pA", 2), ("pC", 1)]
    full = top_products.top_products(mk(spark, evs), n=3)
    served = serving.top_products_for_hour(full, "2024010100")
    assert [r.product_id for r in served.orderBy("position").collect()] == ["pC", "pB", "pA"]


def _carts(spark, evs, **kw):
    df = mk(spark, evs)
    a = rows(as_naive(carts.abandoned_carts(df, **kw)))
    if "as_of" not in kw:
        b = rows(as_naive(carts.abandoned_carts_sessions(df, kw.get("timeout", "30 minutes"))))
        assert a == b
    return a


def test_cart_cases(spark):
    c = "c1"
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0))]) == [(c, minutes(30))]
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0)),
                          cart_event(2, "checkout", c, minutes(10))]) == []
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0)),
                          cart_event(2, "add_to_cart", c, minutes(20))]) == [(c, minutes(50))]
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0)),
                          cart_event(2, "checkout", c, minutes(40))]) == [(c, minutes(30))]
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0)),
                          cart_event(2, "add_to_cart", c, minutes(100))]) == [
        (c, minutes(30)), (c, minutes(130))]
    assert _carts(spark, [cart_event(1, "checkout", c, minutes(0)),
                          cart_event(2, "page_view", c, minutes(1))]) == []
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(0)),
                          cart_event(2, "checkout", c, minutes(30))]) == []
    # add and checkout at the same instant: the checkout closes the cart
    assert _carts(spark, [cart_event(1, "add_to_cart", c, minutes(3)),
                          cart_event(2, "checkout", c, minutes(3))]) == []


def test_cart_as_of(spark):
    evs = [cart_event(1, "add_to_cart", "c1", minutes(0)),
           cart_event(2, "add_to_cart", "c2", minutes(50))]
    got = _carts(spark, evs, as_of=minutes(60).strftime("%Y-%m-%d %H:%M:%S"))
    assert got == [("c1", minutes(30))]


def _decode(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return codec.decode_events(df).collect()


def test_coercion(spark):
    r = _decode(spark, ['{"eventId":"a","productPrice":"12.5","productQuantity":"4"}',
                        '{"eventId":"b","productQuantity":3.7,"userId":42}'])
    assert (r[0].productPrice, r[0].productQuantity, r[0].reason) == (12.5, 4, None)
    assert (r[1].productQuantity, r[1].userId, r[1].reason) == (3, "42", None)


def test_bad_bodies(spark):
    r = _decode(spark, ["not json", "", "null", "[1]", None, '{"eventId":NaN}',
                        '{"eventId":"a","zzz":1}', '{"productQuantity":99999999999}',
                        '{"productPrice":"abc"}'])
    assert [x.reason for x in r] == ["malformed"] * 6 + ["unknown_field", "bad_type", "bad_type"]


def test_strict_mode_fails(spark):
    import pytest
    df = spark.createDataFrame([('{"eventId":"a","zzz":1}',)], "value string")
    with pytest.raises(Exception):
        codec.decode_events(df, mode="strict").collect()


def test_duplicate_transaction_and_null_category(spark):
    tx = spark.createDataFrame(
        [("t1", "p", "c1", 1.0, dt.datetime(2024, 1, 1), 1),
         ("t1", "p", "c1", 2.0, dt.datetime(2024, 1, 2), 1),
         ("t2", "p", None, 5.0, dt.datetime(2024, 1, 1), 1)],
        "transaction_id string, product_id string, product_category string, total_amount double, "
        "transaction_date timestamp, product_quantity int")
    assert rows(sales.latest_transactions(tx), "transaction_id", "total_amount") == [
        ("t1", 2.0), ("t2", 5.0)]
    assert rows(sales.sales_per_category(tx), "category", "total_sales") == [
        ("c1", 1.0), ("c1", 2.0)]
    assert rows(sales.sales_per_day(tx), "total_sales") == [(2.0,), (6.0,)]
    assert rows(sales.sales_per_day(tx, dedupe=True), "total_sales") == [(2.0,), (5.0,)]
    assert sales.null_key_rows(tx).count() == 1


def test_message_key(spark):
    df = mk(spark, [{"eventId": "e1", "userId": "", "cartId": "c1", "event_ts": minutes(0)},
                    {"eventId": "e2", "event_ts": minutes(0)},
                    {"eventId": "e3", "userId": "u3", "event_ts": minutes(0)}])
    got = rows(df.select("eventId", events.message_key().alias("k")))
    assert got == [("e1", "c1"), ("e2", "e2"), ("e3", "u3")]


def test_encode_decode_round_trip(spark):
    df = mk(spark, [{"eventId": "e1", "eventType": "add_to_cart", "productPrice": 10.25,
                     "productQuantity": 3, "totalAmount": 30.75, "cartId": "c1",
                     "event_ts": minutes(0)}])
    df = df.withColumn("timestamp", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    msg = events.event_messages(df)
    assert "null" not in msg.first().value       # absent fields are omitted
    back = codec.decode_events(msg).first()
    assert (back.eventId, back.productPrice, back.productQuantity, back.totalAmount,
            back.reason) == ("e1", 10.25, 3, 30.75, None)


def test_empty_serving_reads(spark):
    au = spark.createDataFrame([], "minute_ts timestamp, users bigint")
    assert serving.current_active_users(au).first()[0] == 0
    ab = spark.createDataFrame([], "cart_id string, abandoned_at timestamp")
    assert carts.abandoned_count(ab).first()[0] == 0
    top = spark.createDataFrame([], "hour_ts timestamp, product_id string, amount double")
    assert serving.top_products_for_hour(top, "2024010100").count() == 0


def test_timeout_from_env():
    assert carts.timeout_from_env("45") == "45 minutes"
    assert carts.timeout_from_env("abc") == "30 minutes"
    assert carts.timeout_from_env(None) == "30 minutes"


def test_non_finite_amounts_keep_double_semantics(spark):
    import math
    evs = [{"eventId": str(i), "eventType": "add_to_cart", "productId": p, "totalAmount": a,
            "event_ts": minutes(i)}
           for i, (p, a) in enumerate([("pA", 1.25), ("pA", float("nan")), ("pB", 2.5),
                                       ("pB", 0.5), ("pC", float("inf")), ("pD", 3.0)])]
    top = {r.product_id: r.amount for r in top_products.top_products(mk(spark, evs), n=4).collect()}
    assert math.isnan(top["pA"]) and top["pB"] == 3.0 and top["pC"] == float("inf")
    ranked = [r.product_id for r in top_products.top_products(mk(spark, evs), n=4)
              .orderBy("product_rank").collect()]
    assert ranked == ["pA", "pC", "pB", "pD"]          # NaN ranks highest, as in Spark
    tx = spark.createDataFrame(
        [("t1", "c", float("inf"), dt.datetime(2024, 1, 1)),
         ("t2", "c", float("-inf"), dt.datetime(2024, 1, 2)),
         ("t3", "c", 0.1, dt.datetime(2024, 1, 1))],
        "transaction_id string, product_category string, total_amount double, "
        "transaction_date timestamp")
    run = [r.total_sales for r in sales.sales_per_category_running(tx).orderBy("transaction_date")
           .collect()]
    assert run[0] == float("inf") and math.isnan(run[1])


def test_non_numeric_text_is_bad_type(spark):
    r = _decode(spark, ['{"eventId":"a","totalAmount":"NaN"}', '{"eventId":"b","productPrice":"Infinity"}',
                        '{"eventId":"c","productPrice":"0.1"}'])
    assert [x.reason for x in r] == ["bad_type", "bad_type", None]
