"""Declared-key checks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count (empty when
    the key holds). Partial aggregation keeps a hot key to one row per task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
            .filter(F.col("n_rows") > 1))
