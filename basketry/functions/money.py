"""Money arithmetic.

Amounts are doubles (the input contract) and totals are their sums.  Adding
doubles gives a result that depends on the order rows meet, i.e. on
partitioning, so amounts are summed as decimals with 8 places: exact and
order-free for every amount with up to 8 decimals, and within 5e-9 per amount
otherwise.  No amount is rounded to cents and none can fail the job: a total
with an amount the decimal can't hold (1e20 and above, NaN, infinities), or
whose decimal sum would overflow, is the plain double sum instead.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Names of the partial columns of a money total.
PARTS = ("exact", "approx", "wide")

EXACT = "decimal(28,8)"
LIMIT = 1e20


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fits(c: Column | str) -> Column:
    """Is the amount finite and below the exact range's limit? (NaN is not.)"""
    return F.abs(_c(c)) < F.lit(LIMIT)


def money_parts(c: Column | str, prefix: str = "") -> list[Column]:
    """Aggregate columns of a money sum (use inside ``agg``)."""
    c = _c(c)
    return [F.try_sum(F.when(fits(c), c.cast(EXACT))).alias(prefix + "exact"),
            F.sum(c).alias(prefix + "approx"),
            F.max(~fits(c)).alias(prefix + "wide")]


def _total(exact: Column, approx: Column, wide: Column) -> Column:
    return F.when(wide | exact.isNull(), approx).otherwise(exact.cast("double"))


def money_total(prefix: str = "") -> Column:
    """The double total from the parts made by ``money_parts``."""
    return _total(*[F.col(prefix + p) for p in PARTS])


def running_parts(window: Window, prefix: str = "") -> list[Column]:
    """Running versions of the parts over ``window`` (rows of partial totals).

    An overflow of any row so far makes the running total a double sum.
    """
    exact, approx, wide = (prefix + p for p in PARTS)
    lost = F.col(exact).isNull() & F.col(approx).isNotNull()
    return [F.try_sum(exact).over(window).alias(exact),
            F.sum(approx).over(window).alias(approx),
            F.max(F.col(wide) | lost).over(window).alias(wide)]


def folded_parts(prefix: str = "") -> list[Column]:
    """Aggregate columns that fold partial totals into a wider one (use inside ``agg``)."""
    exact, approx, wide = (prefix + p for p in PARTS)
    lost = F.col(exact).isNull() & F.col(approx).isNotNull()
    return [F.try_sum(exact).alias(exact), F.sum(approx).alias(approx),
            F.max(F.col(wide) | lost).alias(wide)]


def money_sum(c: Column | str) -> Column:
    """Sum of a money column as one aggregate expression (double)."""
    return _total(*money_parts(c))
