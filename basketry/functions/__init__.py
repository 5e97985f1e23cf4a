"""Column-level building blocks: native Spark expressions only."""

from basketry.functions.money import money_sum, money_total  # noqa: F401
from basketry.functions.timeparse import event_time, to_epoch_ms  # noqa: F401
