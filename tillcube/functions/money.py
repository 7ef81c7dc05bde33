"""Money and ratio column expressions (JVM-side, codegen friendly).

Money is exact decimal inside a job; only final sums are turned into
double.  Averages are ``double(sum) / count`` so that they do not depend on
Spark's rounding of ``avg(decimal)`` to 6 places.  No decimal is ever
divided: a percentage is applied by multiplying with ``0.01``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(10,2)"
MONEY = "decimal(12,2)"
PERCENT = "decimal(5,2)"


def _hundredth() -> Column:
    return F.lit(0.01).cast("decimal(2,2)")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def net_factor(discount_percent) -> Column:
    """``1 - discount_percent / 100`` kept exact."""
    return F.lit(1) - _c(discount_percent) * _hundredth()


def sale_amount(quantity, selling_price, discount_percent) -> Column:
    """P10: ``qty * sell * (1 - disc/100)`` rounded half-up to 2 places."""
    return (_c(quantity) * _c(selling_price) * net_factor(discount_percent)).cast(MONEY)


def sale_profit(quantity, selling_price, cost_price, discount_percent) -> Column:
    """P10: profit from the *unrounded* amount minus ``qty * cost``, rounded to 2."""
    gross = _c(quantity) * _c(selling_price) * net_factor(discount_percent)
    return (gross - _c(quantity) * _c(cost_price)).cast(MONEY)


def cost_amount(amount, profit) -> Column:
    """``sale_amount - profit``."""
    return (_c(amount) - _c(profit)).cast(MONEY)


def cents(x) -> Column:
    """A money value (scale <= 2) as whole cents in a long, exactly."""
    return (_c(x) * F.lit(100).cast("decimal(3,0)")).cast("long")


def money_sum(x) -> Column:
    """Exact sum of money values (scale <= 2), returned as double.

    Summed as long cents: a long add per row instead of a wide decimal add,
    exact up to 9.2e16 currency units (beyond that ANSI mode raises rather
    than wrap).  ``double(cents) / 100`` is one correctly rounded division,
    so the value equals the exact decimal sum cast to double.
    """
    return F.sum(cents(x)).cast("double") / F.lit(100.0)


def exact_avg(x) -> Column:
    """Average of money values as ``double(exact sum) / count``; NULL over no rows."""
    return F.try_divide(money_sum(x), F.count(_c(x)).cast("double"))


def guarded_percent(part, whole) -> Column:
    """``part / whole * 100`` when ``whole > 0`` else 0."""
    return F.when(_c(whole) > 0, _c(part) / _c(whole) * F.lit(100.0)).otherwise(F.lit(0.0))


def ratio_percent(part, whole) -> Column:
    """``part * 1.0 / whole * 100`` in double; NULL when ``whole`` is 0."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0)
