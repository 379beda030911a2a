"""Exact decimal rounding of ratios, computed on integers.

``round(double, 2)`` disagrees between engines at ties, and Spark's ``avg``
of integers is a double where a numeric average is exact. Every ratio here is
therefore computed on ``bigint`` operands: for ``a / b`` scaled by ``10**k``
and rounded half away from zero to ``s`` decimals, the result in units of
``10**-s`` is ``sign(a) * ((|a| * 2 * 10**(k+s) + b) div (2b))``, which is then
divided by ``10**s`` once (an exactly rounded double). ``b = 0`` or NULL gives
NULL, like ``NULLIF(b, 0)``.

Operands must be integral. The scaled numerator has to fit in 63 bits: at
``k + s = 4`` (percent with two decimals) counts up to 4.6e14 are safe; ANSI
mode raises on overflow instead of returning a wrong value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _scaled_quotient(num, den, scale: int, places: int) -> Column:
    a = _col(num).cast("bigint")
    b = _col(den).cast("bigint")
    factor = F.lit(2 * 10 ** (scale + places)).cast("bigint")
    units = F.call_function("div", F.abs(a) * factor + F.abs(b), F.abs(b) * 2)
    negative = (a < 0) != (b < 0)
    signed = F.when(negative, -units).otherwise(units)
    return F.when(b != 0, signed.cast("double") / F.lit(10 ** places))


def pct(num, den, places: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, places)`` exactly."""
    return _scaled_quotient(num, den, 2, places)


def ratio(num, den, places: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), places)`` exactly."""
    return _scaled_quotient(num, den, 0, places)


def avg_exact(total, count, places: int = 2) -> Column:
    """``ROUND(AVG(x), places)`` from ``SUM(x)`` and ``COUNT(x)``."""
    return ratio(total, count, places)


def round_half_away(c, places: int = 0) -> Column:
    """Round a double half away from zero (numeric ``ROUND`` semantics).

    Spark's ``round`` on doubles is HALF_UP, i.e. away from zero for both
    signs, which is what a numeric insert into an integer column does.
    """
    return F.round(_col(c), places)
