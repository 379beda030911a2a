"""Occupancy and revenue estimates over a listing row.

A listing that has availability is assumed booked for the nights of the next
30 that are not available; an inactive listing earns nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NIGHTS_WINDOW = 30


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(c) -> Column:
    """``c = true`` as a CASE condition: NULL counts as not true."""
    return _col(c) == F.lit(True)


def flag_count(condition: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as bigint (0, never NULL, per row)."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))


def active_only(value, active="has_availability") -> Column:
    """``CASE WHEN active THEN value END``."""
    return F.when(is_true(active), _col(value))


def estimated_nights(active="has_availability", availability="availability_30") -> Column:
    """``CASE WHEN active THEN 30 - availability_30 ELSE 0 END``."""
    return (F.when(is_true(active), F.lit(NIGHTS_WINDOW) - _col(availability).cast("bigint"))
            .otherwise(F.lit(0).cast("bigint")))


def estimated_revenue(active="has_availability", availability="availability_30",
                      price="price") -> Column:
    """Nights times price, in bigint so sums cannot overflow an int."""
    return estimated_nights(active, availability) * _col(price).cast("bigint")
