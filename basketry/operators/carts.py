"""Abandoned carts: an add-to-cart with no later add or checkout within T.

Per cart the reference runs a timer machine: an add (re)arms a timer at
t + T, a checkout disarms it, a firing timer with the cart still open emits
the cart.  Hence an add is emitted iff the cart's *next* add/checkout comes
more than T later (or never); it is emitted at ``add + T``.  A checkout
without an add emits nothing; a cart can be emitted again after a new add.

Event order within a cart is (event time, adds before checkouts): a
checkout at the same instant as an add closes the cart.

Main form (batch and stream) — aggregation only, no per-cart sort.  Cut
time into slices of width T.  An add can only be emitted if it is the last
event of its (cart, slice): any later event of the same slice is less than T
away.  For that last event the next one is the first event after the slice,
and only events up to T after the slice matter.  So a sliding window of
2 slices, grouped by (cart, window), with two partial aggregates — last
event of the first slice, first event time of the second — decides
everything.  A cart holding a third of all events still never lands in one
task: the aggregates combine map-side before the shuffle.

Low-latency stream form — ``session_window(ts, T)`` per cart: a session
whose last event is an add closes at ``add + T`` = the abandonment time, but
the session operator sorts each cart's events of a micro-batch in one task.  Events
exactly T apart fall into one session (the reference re-arms at equality).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.intervals import interval_micros
from basketry.operators.events import event_time_gate

TIMEOUT = "30 minutes"


def timeout_from_env(value: str | None, default_minutes: int = 30) -> str:
    """Timeout minutes from configuration text; non-numeric -> default."""
    try:
        minutes = int(str(value).strip())
    except (TypeError, ValueError):
        minutes = default_minutes
    return f"{minutes} minutes"


def cart_events(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Add/checkout events that carry a cart: (cart_id, ts, is_checkout)."""
    t = F.coalesce("eventType", F.lit("")) if events.isStreaming else F.col("eventType")
    gate = lambda v: event_time_gate(events, v, ts)
    # On streams: no null-intolerant test of cartId alone, or the optimizer
    # infers "cartId IS NOT NULL" and pushes it below the watermark.
    has_cart = F.coalesce(F.col("cartId") >= gate(F.lit("")), F.lit(False)) \
        if events.isStreaming else F.col("cartId").isNotNull()
    return (events.filter(has_cart & t.isin(gate(F.lit(schemas.ADD_TO_CART)),
                                            gate(F.lit(schemas.CHECKOUT))))
                  .select(F.col("cartId").alias("cart_id"), F.col(ts).alias("ts"),
                          (t == schemas.CHECKOUT).cast("int").alias("is_checkout")))


def order_key(ts: Column, is_checkout: Column) -> Column:
    """One long that orders events (time, adds first): max() = last event."""
    return F.unix_micros(ts) * 2 + is_checkout


def _interval(us: int) -> str:
    return f"{us // 1_000_000} seconds" if us % 1_000_000 == 0 else f"{us} microseconds"


def abandoned_carts(events: DataFrame, timeout: str = TIMEOUT,
                    as_of: str | dt.datetime | None = None,
                    ts: str = "event_ts", resolution: int = 1) -> DataFrame:
    """(cart_id, abandoned_at) — batch and stream, aggregation only.

    Slices of width s = T / ``resolution``; windows of length s + T sliding
    by s.  Per (cart, window): the last event of the first slice (max of the
    order key) and the first event time after it (min over the rest).  An
    add is abandoned iff it is the last event of its slice (a later event of
    the same slice is less than T away) and the first event after the slice
    is more than T after it, or absent.  Every add is judged in exactly one
    window, the one whose first slice holds it.

    Both values are partial aggregates, so a cart holding a third of all
    events is combined map-side and never sorted in one task.  On a stream
    a window is emitted when the watermark passes its end, at most s after
    ``add + T``; ``resolution`` trades that delay against (resolution + 1)
    copies of each cart event.

    ``as_of`` (batch): only carts whose timer has fired by then
    (``abandoned_at <= as_of``).  Events after ``as_of`` cannot change such
    rows, so they are filtered before the scan.
    """
    t_us = interval_micros(timeout)
    if resolution < 1 or t_us % resolution:
        raise ValueError("resolution must divide the timeout")
    s_us = t_us // resolution
    ev = cart_events(events, ts)
    if as_of is not None:
        as_of_col = F.lit(as_of).cast("timestamp")
        ev = ev.filter(F.col("ts") <= as_of_col)
    w = F.window("ts", _interval(t_us + s_us), _interval(s_us))
    ev = ev.select("cart_id", "ts", "is_checkout", w.alias("w"))
    us = F.unix_micros("ts")
    in_first_slice = us < F.unix_micros("w.start") + F.lit(s_us)
    per_window = ev.groupBy("cart_id", "w").agg(
        F.max(F.when(in_first_slice, order_key(F.col("ts"), F.col("is_checkout"))))
         .alias("last_key"),
        F.min(F.when(~in_first_slice, us)).alias("next_us"))
    t = F.lit(t_us)
    add_us = F.shiftright("last_key", 1)
    out = (per_window.filter(F.col("last_key").isNotNull()
                             & (F.col("last_key").bitwiseAND(1) == 0))
                     .filter(F.col("next_us").isNull() | (F.col("next_us") > add_us + t))
                     .select("cart_id", F.timestamp_micros(add_us + t).alias("abandoned_at")))
    if as_of is not None:
        out = out.filter(F.col("abandoned_at") <= as_of_col)
    return out


def abandoned_carts_sessions(events: DataFrame, timeout: str = TIMEOUT,
                             ts: str = "event_ts") -> DataFrame:
    """(cart_id, abandoned_at) via session windows — stream and batch."""
    ev = cart_events(events, ts)
    return (ev.groupBy("cart_id", F.session_window("ts", timeout).alias("s"))
              .agg(F.max(order_key(F.col("ts"), F.col("is_checkout"))).alias("last_key"))
              .filter(F.col("last_key").bitwiseAND(1) == 0)
              .select("cart_id", F.col("s.end").alias("abandoned_at")))


def abandoned_count(abandoned: DataFrame) -> DataFrame:
    """Count of abandoned carts, derived from the keyed table (replay-safe)."""
    return abandoned.agg(F.count(F.lit(1)).alias("abandoned_carts_count"))


def recent_abandoned(abandoned: DataFrame, n: int = 20) -> DataFrame:
    """Newest first, like a list with pushes at the head."""
    return abandoned.orderBy(F.desc("abandoned_at"), F.desc("cart_id")).limit(n)
