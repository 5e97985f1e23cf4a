"""Interval text ("30 minutes", "1 hour") to microseconds, without a Spark job."""

from __future__ import annotations

import re

_UNIT_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not an interval: {text!r}")
    for num, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNIT_US:
            raise ValueError(f"unknown unit {unit!r} in {text!r}")
        total += int(num) * _UNIT_US[u]
    return total
