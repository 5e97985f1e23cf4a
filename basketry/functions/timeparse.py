"""Event time from the envelope's ISO-8601 text.

The contract: the text must be an ISO-8601 local date-time with an explicit
offset (``Z`` or ``±hh[:mm[:ss]]``); it becomes an instant truncated to the
millisecond.  Anything else — null, garbage, a zone-less date-time, a bare
date, an impossible hour — falls back to the record's own timestamp (the
Kafka record time, or the file modification time for file sources).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shape of the event timestamp text.
ISO_OFFSET_DATE_TIME = (
    r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$"
)
# A time without seconds ("...T01:23+02:00") is valid ISO; give it ":00" so
# the cast-style parser accepts it.
_NO_SECONDS = r"(?i)^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(?=[Z+-])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_epoch_ms(c: Column | str) -> Column:
    """Timestamp -> epoch milliseconds (bigint)."""
    return F.unix_millis(_col(c))


def parse_iso_offset(text: Column | str) -> Column:
    """ISO text with offset -> timestamp truncated to ms; null when invalid."""
    text = _col(text)
    norm = F.regexp_replace(text, _NO_SECONDS, "$1:00")
    parsed = F.try_to_timestamp(norm)
    return F.when(text.rlike(ISO_OFFSET_DATE_TIME),
                  F.timestamp_millis(F.unix_millis(parsed)))


def event_time(text: Column | str, record_ts: Column | str) -> Column:
    """B1: parsed event time, else the record timestamp."""
    return F.coalesce(parse_iso_offset(text), _col(record_ts).cast("timestamp"))
