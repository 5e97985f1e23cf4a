"""Property tests against small reference models (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators import active_users, carts, top_products
from tests.conftest import rows
from tests.helpers import T0, as_naive, events as mk

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_force_carts(evs, timeout_min):
    """The timer machine: add arms (or re-arms) at t + T, checkout disarms,
    a timer fires before any event later than its deadline."""
    out = []
    t = dt.timedelta(minutes=timeout_min)
    by_cart = {}
    for kind, cart, ts in evs:
        if cart is not None and kind in ("add_to_cart", "checkout"):
            by_cart.setdefault(cart, []).append((ts, kind == "checkout", kind))
    for cart, es in by_cart.items():
        deadline = None
        for ts, _, kind in sorted(es):
            if deadline is not None and deadline < ts:
                out.append((cart, deadline))
                deadline = None
            deadline = ts + t if kind == "add_to_cart" else None
        if deadline is not None:
            out.append((cart, deadline))
    return sorted(out)


cart_event = st.tuples(st.sampled_from(["add_to_cart", "checkout", "page_view"]),
                       st.sampled_from(["c1", "c2", None]),
                       st.integers(min_value=0, max_value=240))


@SETTINGS
@given(st.lists(cart_event, max_size=25), st.sampled_from([10, 30]))
def test_abandoned_carts_match_timer_machine(spark, evs, timeout):
    timed = [(k, c, T0 + dt.timedelta(minutes=m)) for k, c, m in evs]
    df = mk(spark, [{"eventId": f"e{i}", "eventType": k, "cartId": c, "event_ts": ts}
                    for i, (k, c, ts) in enumerate(timed)])
    expect = brute_force_carts(timed, timeout)
    assert rows(as_naive(carts.abandoned_carts(df, f"{timeout} minutes"))) == expect
    assert rows(as_naive(carts.abandoned_carts(df, f"{timeout} minutes", resolution=5))) == expect
    assert rows(as_naive(carts.abandoned_carts_sessions(df, f"{timeout} minutes"))) == expect


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3", None]),
                          st.integers(min_value=0, max_value=20 * 60)), max_size=30))
def test_active_users_match_sets(spark, views):
    df = mk(spark, [{"eventId": str(i), "eventType": "page_view", "userId": u,
                     "event_ts": T0 + dt.timedelta(seconds=s)} for i, (u, s) in enumerate(views)])
    expect = {}
    for u, s in views:
        m = s // 60
        for end in range(m + 1, m + 6):
            expect.setdefault(end, set())
            if u is not None:
                expect[end].add(u)
    want = sorted((T0 + dt.timedelta(minutes=e), len(us)) for e, us in expect.items())
    assert rows(as_naive(active_users.active_users(df)), "minute_ts", "users") == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([f"p{i}" for i in range(6)]),
                          st.integers(min_value=0, max_value=2000),
                          st.integers(min_value=0, max_value=179)), max_size=30),
       st.integers(min_value=1, max_value=4))
def test_top_n_match_sorted_lists(spark, sales, n):
    df = mk(spark, [{"eventId": str(i), "eventType": "add_to_cart", "productId": p,
                     "totalAmount": c / 100.0, "event_ts": T0 + dt.timedelta(minutes=m)}
                    for i, (p, c, m) in enumerate(sales)])
    per_hour = {}
    for p, c, m in sales:
        h = per_hour.setdefault(m // 60, {})
        h[p] = h.get(p, 0) + c
    want = []
    for h, prods in per_hour.items():
        ranked = sorted(prods.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
        want += [(T0 + dt.timedelta(hours=h), p, c / 100.0) for p, c in ranked]
    got = rows(as_naive(top_products.top_products(df, n)), "hour_ts", "product_id", "amount")
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3", "t4"]),
                          st.sampled_from(["home", "beauty", None]),
                          st.integers(min_value=0, max_value=100000),
                          st.integers(min_value=0, max_value=90)), max_size=25))
def test_sales_rollups_match_python_sums(spark, txs):
    from basketry.operators import sales
    rows_in = [(tid, cat, cents / 100.0, T0 + dt.timedelta(days=d), f"p{i}", 1)
               for i, (tid, cat, cents, d) in enumerate(txs)]
    tx = spark.createDataFrame(rows_in, "transaction_id string, product_category string, "
                               "total_amount double, transaction_date timestamp, "
                               "product_id string, product_quantity int")
    by_day, by_cat, by_month = {}, {}, {}
    for tid, cat, cents, d in txs:
        day = (T0 + dt.timedelta(days=d)).date()
        by_day[day] = by_day.get(day, 0) + cents
        by_month[(day.year, day.month)] = by_month.get((day.year, day.month), 0) + cents
        if cat is not None:
            by_cat[(day, cat)] = by_cat.get((day, cat), 0) + cents
    assert rows(sales.sales_per_day(tx)) == sorted((k, v / 100.0) for k, v in by_day.items())
    assert rows(sales.sales_per_category(tx)) == sorted(
        (k[0], k[1], v / 100.0) for k, v in by_cat.items())
    assert rows(sales.sales_per_month(tx)) == sorted(
        (k[0], k[1], v / 100.0) for k, v in by_month.items())
    # last write wins: the max of (date, product id, amount, quantity) per id
    last = {}
    for i, (tid, cat, cents, d) in enumerate(txs):
        key = (T0 + dt.timedelta(days=d), f"p{i}", cents / 100.0, 1)
        if tid not in last or key > last[tid]:
            last[tid] = key
    got = rows(sales.latest_transactions(tx), "transaction_id", "transaction_date",
               "product_id", "total_amount")
    assert got == sorted((t, k[0], k[1], k[2]) for t, k in last.items())
    dedup_day = {}
    for t, k in last.items():
        dedup_day[k[0].date()] = dedup_day.get(k[0].date(), 0) + round(k[2] * 100)
    assert rows(sales.sales_per_day(tx, dedupe=True)) == sorted(
        (k, v / 100.0) for k, v in dedup_day.items())
