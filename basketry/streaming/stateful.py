"""Abandoned carts with timers: on the wall clock or on event time.

The aggregate in ``operators/carts.py`` is the default.  The two timer
machines here run as ``transformWithState`` keyed by cart: Spark
shuffles by cart and keeps small state cells per cart in RocksDB.

*Processing time* is the original machine: per cart, an add (re)arms a timer
at now + T, a checkout disarms it, and a firing timer with the cart still open
emits the cart.  Within one micro-batch every event is handled at the same
processing time, so only the last event of a cart in that batch decides.

*Event time* gives the result of the default form, each cart being emitted as
soon as the watermark passes ``add + T``.  Time is cut into slices of length T;
of a (cart, slice) only the first event's time and the last event matter: an
add is abandoned if it is the last of its slice and the next slice's first
event is absent or more than T later.  A slice is dropped from the state when
the watermark passes the end of the next one.

Both summaries merge in any order, so each input task reduces its rows to one
per Arrow batch and cart (and slice) before the shuffle: a cart with a third of
all rows reaches its worker as a few rows a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from basketry.functions.intervals import interval_micros
from basketry.operators.carts import cart_events, order_key

OUTPUT_SCHEMA = "cart_id string, abandoned_at timestamp"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CartTimers(StatefulProcessor):
    """Timer machine per cart: state ``armed`` (bool) and ``deadline`` (ms)."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.armed = handle.getValueState("armed", "armed boolean")
        self.deadline = handle.getValueState("deadline", "deadline long")

    def _disarm(self) -> None:
        if self.deadline.exists():
            self.handle.deleteTimer(self.deadline.get()[0])
        self.armed.clear()
        self.deadline.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in rows:
            if len(pdf):
                i = pdf["okey"].idxmax()
                if last is None or pdf.at[i, "okey"] > last:
                    last = int(pdf.at[i, "okey"])
        if last is None:
            return iter([])
        self._disarm()
        if last % 2 == 0:                       # the batch ends with an add
            at = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
            self.handle.registerTimer(at)
            self.armed.update((True,))
            self.deadline.update((at,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = self.armed.exists() and bool(self.armed.get()[0])
        self.armed.clear()
        self.deadline.clear()
        if fired:
            yield pd.DataFrame({
                "cart_id": [key[0]],
                "abandoned_at": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")],
            })

    def close(self) -> None:
        pass


class CartSlices(StatefulProcessor):
    """Event-time machine per cart: the live slices' (first time, last event) and one timer.

    The timer stands at the earliest time at which something is due: a slice's
    ending add plus T, or the end of the slice after it, when the slice goes.
    A timer fires when the watermark reaches it, and a row at exactly add + T
    still closes the cart, so both times count from the millisecond after.
    Rows of a slice that has gone already are late and take no part.
    """

    def __init__(self, timeout_us: int):
        self.t = timeout_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState(
            "live", "slice array<long>, first array<long>, last array<long>, judged array<boolean>, timer long")

    def _gone_ms(self, k: int) -> int:
        return (k + 2) * self.t // 1000 + 1

    def _due_ms(self, k: int, last: int, judged: bool) -> int:
        if last % 2 or judged:
            return self._gone_ms(k)
        return (last // 2 + self.t) // 1000 + 1

    def _load(self) -> tuple[dict[int, list], int | None]:
        held = self.live.get()
        if held is None:
            return {}, None
        slices, first, last, judged, timer = held
        return {k: [f, e, j] for k, f, e, j in zip(slices, first, last, judged)}, timer

    def _store(self, live: dict[int, list], timer: int | None) -> None:
        """Keep the live slices and move the one timer to the next time that is due."""
        due = min((self._due_ms(k, e, j) for k, (_, e, j) in live.items()), default=None)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if due is None:
            self.live.clear()
            return
        slices = sorted(live)
        first, last, judged = (list(x) for x in zip(*(live[k] for k in slices)))
        self.live.update((slices, first, last, judged, due))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        live, timer = self._load()
        mark = timerValues.getCurrentWatermarkInMs()
        for _, k, first, last in rows:
            if self._gone_ms(k) <= mark:
                continue
            if k not in live:
                live[k] = [first, last, False]
                continue
            held = live[k]
            held[0] = min(held[0], first)
            if last > held[1]:
                held[1:] = [last, False]
        self._store(live, timer)
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        live, _ = self._load()  # the fired timer is gone
        mark = timerValues.getCurrentWatermarkInMs()
        out = []
        for k in sorted(live):
            _, last, judged = live[k]
            if last % 2 == 0 and not judged and self._due_ms(k, last, judged) <= mark:
                after = live.get(k + 1)
                if after is None or after[0] > last // 2 + self.t:
                    out.append(last // 2 + self.t)
                live[k][2] = True
        self._store({k: v for k, v in live.items() if self._gone_ms(k) > mark}, None)
        for us in out:
            yield Row(cart_id=key[0], abandoned_us=us)

    def close(self) -> None:
        pass


def reduced(rows: DataFrame, keys: list[str], how: dict[str, str]) -> DataFrame:
    """``rows`` with one row per Arrow batch and ``keys``; ``how`` gives min or max of each other column.

    A stateless reduction ahead of a stateful operator's shuffle, where a
    streaming aggregate would hold rows back until its window closes.
    """
    columns = [*keys, *how]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.select(*columns).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(keys).aggregate(list(how.items()))
            t = t.select([*keys, *(f"{c}_{f}" for c, f in how.items())]).rename_columns(columns)
            yield from t.to_batches()

    return rows.select(*columns).mapInArrow(run, schema)


def abandoned_carts_event_time(events: DataFrame, timeout: str = "30 minutes",
                               ts: str = "event_ts") -> DataFrame:
    """Streaming (cart_id, abandoned_at), emitted once the watermark passes ``abandoned_at``.

    ``events`` carries a watermark on ``ts``.  A row that comes late still
    counts while its slice is held; an emitted cart is not taken back.  Needs
    the RocksDB state store provider and the append output mode.
    """
    t = interval_micros(timeout)
    us = F.unix_micros("ts")
    ev = cart_events(events, ts).select(
        "cart_id", F.expr(f"(unix_micros(ts) - pmod(unix_micros(ts), {t}L)) div {t}L").alias("slice"), us.alias("first"),
        order_key(F.col("ts"), F.col("is_checkout")).alias("last"))
    keyed = reduced(ev, ["cart_id", "slice"], {"first": "min", "last": "max"})
    out = keyed.groupBy("cart_id").transformWithState(
        CartSlices(t), "cart_id string, abandoned_us long", "Append", "EventTime")
    return out.select("cart_id", F.timestamp_micros("abandoned_us").alias("abandoned_at"))


def abandoned_carts_processing_time(events: DataFrame, timeout: str = "30 minutes",
                                    ts: str = "event_ts") -> DataFrame:
    """Streaming (cart_id, abandoned_at) with wall-clock timers.

    Needs the RocksDB state store provider on the session
    (``spark.sql.streaming.stateStore.providerClass``) and the update or
    append output mode.
    """
    ev = cart_events(events, ts)
    keyed = ev.select("cart_id", order_key(F.col("ts"), F.col("is_checkout")).alias("okey"))
    return reduced(keyed, ["cart_id"], {"okey": "max"}).groupBy("cart_id").transformWithStateInPandas(
        CartTimers(interval_micros(timeout) // 1000), OUTPUT_SCHEMA, "Append", "ProcessingTime")
