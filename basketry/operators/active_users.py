"""Active users: exact distinct users over sliding event-time windows.

Batch form (scale form): collapse to distinct (slide bucket, user) first,
then fan each bucket out to the W/S windows that contain it and count
distinct users per window.  Duplicate events of a user inside one bucket
never reach the fan-out, and the distinct count is planned by Spark as a
two-level aggregate keyed by (window, user) — a window with millions of
users is spread over all tasks, never gathered into one.

Stream form: ``countDistinct`` is not allowed on streams, so three chained
append-mode aggregations: (slide pane, user), then (window, user), then
window.  Raw rows meet the first one only, which has one row per pane and
user; the fan-out to the W/S windows starts from there.

Null users stay in the grouping, so a window holding only null users comes
out with 0, like the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.intervals import interval_micros
from basketry.operators.events import page_views

WINDOW = "5 minutes"
SLIDE = "1 minute"


def active_users(events: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                 ts: str = "event_ts", route: bool = True) -> DataFrame:
    """(minute_ts = window end, users) for every non-empty window (batch)."""
    pv = page_views(events) if route else events
    w_us, s_us = interval_micros(window), interval_micros(slide)
    if w_us % s_us:
        return _active_users_windowed(pv, window, slide, ts)
    k = w_us // s_us
    bucket = F.floor(F.unix_micros(F.col(ts)) / F.lit(s_us)).cast("bigint")
    per_bucket = pv.select(bucket.alias("b"), F.col("userId")).distinct()
    # window end (in buckets) for each of the k windows containing bucket b
    fan = per_bucket.select(
        F.explode(F.sequence(F.col("b") + 1, F.col("b") + F.lit(k))).alias("end_b"),
        "userId")
    return (fan.groupBy("end_b")
               .agg(F.countDistinct("userId").alias("users"))
               .select(F.timestamp_micros(F.col("end_b") * F.lit(s_us)).alias("minute_ts"),
                       "users"))


def _active_users_windowed(pv: DataFrame, window: str, slide: str, ts: str) -> DataFrame:
    return (pv.groupBy(F.window(ts, window, slide).alias("w"))
              .agg(F.countDistinct("userId").alias("users"))
              .select(F.col("w.end").alias("minute_ts"), "users"))


def active_users_stream(events: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                        ts: str = "event_ts", route: bool = True) -> DataFrame:
    """Streaming form: chained aggregations (needs a watermark on ``ts``).

    A pane closes before the windows that hold it, so each window still is
    emitted as soon as the watermark passes its end.  Windows that are not a
    multiple of the slide are not unions of panes; they take two aggregations.
    """
    pv = page_views(events) if route else events
    w_us, s_us = interval_micros(window), interval_micros(slide)
    if w_us % s_us == 0 and w_us > s_us:
        panes = pv.groupBy(F.window(ts, slide).alias("pane"), "userId").agg(F.count(F.lit(1)).alias("n"))
        pv = panes.select(F.window_time("pane").alias("pane_ts"), "userId")
        ts = "pane_ts"
    per_user = pv.groupBy(F.window(ts, window, slide).alias("w"), "userId").agg(F.count(F.lit(1)).alias("n"))
    return (per_user.groupBy("w")
                    .agg(F.count("userId").alias("users"))
                    .select(F.col("w.end").alias("minute_ts"), "users"))
