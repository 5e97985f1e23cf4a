"""Small builders for hand-made event frames."""

import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)

ENVELOPE_DDL = ", ".join(
    f"{n} {'int' if t == 'int' else t}" for n, t in schemas.EVENT_FIELDS if n != "timestamp"
) + ", event_ts timestamp"


def minutes(m: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=m)


def events(spark, rows):
    """rows: dicts with envelope fields + 'event_ts' (naive UTC datetime)."""
    names = [n for n, _ in schemas.EVENT_FIELDS if n != "timestamp"] + ["event_ts"]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, ENVELOPE_DDL)


def cart_event(i, kind, cart, ts):
    return {"eventId": f"e{i:04d}", "eventType": kind, "cartId": cart, "event_ts": ts,
            "userId": "u1"}


def as_naive(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c)
                       if dict(df.dtypes)[c] == "timestamp" else F.col(c) for c in df.columns])
