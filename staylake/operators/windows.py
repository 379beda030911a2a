"""Ranking and period-over-period operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.functions.exact import pct

# An order spec is (column name, descending?). NULLs always rank last.
OrderSpec = Sequence[tuple[str, bool]]


def _sort_cols(order: OrderSpec) -> list[Column]:
    return [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in order]


def top_k(df: DataFrame, k: int, order: OrderSpec) -> DataFrame:
    """The first ``k`` rows under ``order`` (per-task top-k, then one merge)."""
    return df.orderBy(*_sort_cols(order)).limit(k)


def top1_per_group(df: DataFrame, keys: Sequence[str], order: OrderSpec) -> DataFrame:
    """The first row of every group; Catalyst adds a partial per-task limit
    (WindowGroupLimit) before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*_sort_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def rank_key(df: DataFrame, order: OrderSpec) -> Column:
    """One value whose ascending order is ``order`` (NULLs last), for ``min_by`` and ``max_by``."""
    fields = []
    for i, (c, desc) in enumerate(order):
        t = df.schema[c].dataType.simpleString()
        if desc and t in ("string", "boolean", "date", "timestamp"):
            raise ValueError(f"descending order needs a numeric column, got {c}: {t}")
        fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append((-F.col(c) if desc else F.col(c)).alias(f"v{i}"))
    return F.struct(*fields)


def first_last(df: DataFrame, order: OrderSpec) -> DataFrame:
    """The rows ranked first and last under ``order`` (one row if only one).

    ``ROW_NUMBER() OVER (ORDER BY ..) IN (1, COUNT(*) OVER ())`` moves every
    row into one partition; here one ``min_by``/``max_by`` aggregate does it
    with a per-task partial result, so only one row per task is merged.
    """
    key = rank_key(df, order)
    row = F.struct(*[F.col(c) for c in df.columns])
    agg = df.agg(F.min_by(row, key).alias("first"), F.max_by(row, key).alias("last"),
                 F.count("*").alias("n"))
    picks = F.when(F.col("n") > 1, F.array("first", "last")).otherwise(F.array("first"))
    return (agg.filter(F.col("n") > 0).select(F.explode(picks).alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in df.columns]))


def running_total(measure: str, keys: Sequence[str], order: str | Column) -> Column:
    """``SUM(x) OVER (PARTITION BY keys ORDER BY order)`` with the default
    frame (all rows up to the current one, peers included)."""
    return F.sum(measure).over(Window.partitionBy(*keys).orderBy(order))


def period_change(df: DataFrame, measure: str, keys: Sequence[str], order: str | Column,
                  out: str, denom: str | None = None, direction: str = "next",
                  places: int = 2) -> DataFrame:
    """Add ``out``: percent change between a period and its neighbour within ``keys``.

    ``direction="next"``: ``(next - this) / denom * 100`` with ``denom`` read on
    the current row (NULL for the last period); ``"previous"``:
    ``(this - previous) / previous denom * 100`` (NULL for the first).
    ``denom`` defaults to ``measure``.
    Apply to an already aggregated frame (one row per key and period); the
    neighbour is looked up once, then divided.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    m = F.col(measure)
    d = F.col(denom or measure)
    if direction == "next":
        df = df.withColumn("_other", F.lead(m).over(w))
        diff, base = F.col("_other") - m, d
    elif direction == "previous":
        df = df.withColumns({"_other": F.lag(m).over(w), "_base": F.lag(d).over(w)})
        diff, base = m - F.col("_other"), F.col("_base")
    else:
        raise ValueError("direction must be 'next' or 'previous'")
    return df.withColumn(out, pct(diff, base, places)).drop("_other", "_base")
