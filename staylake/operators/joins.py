"""Join helpers: checked broadcast, case-folded keys, re-assembly on a row id."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.text import fold

# A lookup side is broadcast only when it provably has at most this many rows.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows.

    The bound is checked, not assumed: ``limit(max_rows + 1).count()`` reads at
    most ``max_rows + 1`` rows. Above the bound the frame is returned as is and
    the join stays a shuffle join (AQE may still convert it from measured sizes).
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def fold_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              how: str = "inner") -> DataFrame:
    """Equi-join on case-folded text keys (``lower(a) = lower(b)``)."""
    return left.join(right, fold(left[left_key]) == fold(right[right_key]), how)


def salted_fold_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
                     hot_rows: int = 1_000_000, null_salts: int = 64) -> DataFrame:
    """``fold_join`` for a lookup too large to broadcast, whose left side may have hot keys.

    Keys are counted (partial aggregation); a key with more than ``hot_rows`` rows is dealt over as
    many salts as it has multiples of that, by a hash of the row, and only the lookup rows of such keys are repeated, once per
    salt. There are at most rows / ``hot_rows`` hot keys; they are broadcast if counted to be few. NULL keys meet nothing
    and are spread over ``null_salts``. ``how``: inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    own = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    keyed = left.withColumns({"_k": fold(F.col(left_key)), "_row": own})
    hot = (keyed.filter(F.col("_k").isNotNull()).groupBy("_k").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
           .select("_k", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")))
    hot = bounded_broadcast(hot)
    salt = (F.when(F.col("_k").isNull(), F.pmod("_row", F.lit(null_salts)))
            .otherwise(F.pmod("_row", F.coalesce("_salts", F.lit(1)))).cast("int"))
    dealt = keyed.join(hot, "_k", "left").withColumn("_salt", salt).drop("_salts", "_row")
    repeated = (right.withColumn("_k", fold(F.col(right_key))).join(hot, "_k", "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts"))
    return dealt.join(repeated, ["_k", "_salt"], how).drop("_k", "_salt")


def assemble(parts: Mapping[str, DataFrame], on: str = "id") -> DataFrame:
    """Inner-join slices that share a row id, keeping one copy of every column.

    This is the general form for slices stored separately. Slices that are
    projections of one table on a unique id need no join at all: see
    ``Warehouse.rows``, which filters the table once instead.
    """
    frames = list(parts.values())
    seen = set(frames[0].columns)
    out = frames[0]
    for f in frames[1:]:
        keep = [on] + [c for c in f.columns if c not in seen]
        seen.update(keep)
        out = out.join(f.select(*keep), on)
    return out
