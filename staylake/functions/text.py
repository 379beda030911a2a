"""Text keys: case folding and the census LGA code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(c) -> Column:
    """Case-folded join key (``lower``)."""
    return F.lower(_col(c))


def lga_code_parse(c) -> Column:
    """``CAST(REPLACE(code, 'LGA', '') AS INTEGER)``; malformed text gives NULL."""
    return F.replace(_col(c), F.lit("LGA"), F.lit("")).try_cast("int")
