"""Type-2 history (slowly changing dimension) with the timestamp strategy.

Versions of a key carry ``valid_from`` (the ``updated_at`` that opened them)
and ``valid_to`` (the ``updated_at`` of the next version, NULL while open);
``scd_id`` is ``md5(key | updated_at)``. ``updated_at`` keeps the type of the
source column; ``order_by`` maps it to a sortable value (text dates are
parsed first, since text order is not time order).
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTORY_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]

HOT_ROWS = 1_000_000  # rows of one key that a single task sorts at most
KEY_GROUPS = 65_536  # hash groups of keys, counted before single keys are

OrderFn = Callable[[Column], Column]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _scd_id(keys: list[str], updated_at: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys],
                             updated_at.cast("string")))


def scd2_bulk(df: DataFrame, key: str | Sequence[str], updated_at: str,
              order_by: OrderFn | None = None, tie_break: str | None = "id",
              unique_key: bool = False, valid_to: Column | None = None) -> DataFrame:
    """History of every key from one input that may hold several periods.

    Equivalent to replaying the periods in time order through ``scd2_merge``:
    rows sharing a key and a point in time (``order_by(updated_at)``) collapse
    to the one with the smallest ``tie_break`` (a pre-aggregated group-by, so
    a hot key shrinks map-side to one row per distinct time), then
    ``valid_to`` is the next version's ``updated_at`` within the key.

    ``unique_key=True`` states that ``key`` is unique in ``df`` (e.g. a
    surrogate row id): every row is then its own open version and no shuffle
    is needed; ``valid_to`` then gives the ends of versions that are closed already.
    """
    keys = _keys(key)
    order_by = order_by or (lambda c: c)
    ts = F.col(updated_at)
    if unique_key:
        return df.withColumns({
            "scd_id": _scd_id(keys, ts),
            "updated_at": ts,
            "valid_from": ts,
            "valid_to": F.lit(None).cast(df.schema[updated_at].dataType) if valid_to is None else valid_to,
        }).select(*[c for c in df.columns if c not in HISTORY_COLUMNS], *HISTORY_COLUMNS)
    cols = df.columns
    if tie_break:
        # one row per (key, point in time): equal dates spelled differently
        # are the same update, as scd2_merge sees them
        packed = F.struct(*[F.col(c) for c in cols])
        df = (df.groupBy(*keys, order_by(ts).alias("_at"))
              .agg(F.min_by(packed, F.col(tie_break)).alias("_row"))
              .select(*[F.col(f"_row.{c}").alias(c) for c in cols]))
    w = Window.partitionBy(*keys).orderBy(order_by(ts).asc_nulls_first(), ts.asc_nulls_first())
    return df.withColumns({
        "scd_id": _scd_id(keys, ts),
        "updated_at": ts,
        "valid_from": ts,
        "valid_to": F.lead(ts).over(w),
    })


def scd2_merge(history: DataFrame, incoming: DataFrame, key: str | Sequence[str],
               updated_at: str, order_by: OrderFn | None = None,
               tie_break: str | None = "id") -> DataFrame:
    """One snapshot run: merge a batch into an existing history.

    The batch may hold several versions of a key: it is first reduced to one
    row per key and point in time (the smallest ``tie_break``, as in
    ``scd2_bulk``), of which those later than the key's open version are kept;
    a missing time is earlier than any other. Open versions and kept rows then
    form one time line per key, whose windows hold a key's new dates, not its
    history. Not later -> no change; keys absent from the batch are untouched;
    closed versions pass through. NULL keys are a key like any other.
    The result must be written to a new location (a table cannot be
    overwritten while it is read).
    """
    closed, line = scd2_parts(history, incoming, key, updated_at, order_by, tie_break)
    return closed.unionByName(line)


def scd2_parts(history: DataFrame, incoming: DataFrame, key: str | Sequence[str], updated_at: str,
               order_by: OrderFn | None = None, tie_break: str | None = "id") -> tuple[DataFrame, DataFrame]:
    """The versions that were closed before, and the merged time lines of the open ones.

    Incoming rows are moved once, by key, and reduced where they arrive; if the batch has a key of more than
    ``HOT_ROWS`` rows, they are reduced in every task first and moved again by key. New versions carry no
    history columns until their time line is built.
    """
    keys = _keys(key)
    order_by = order_by or (lambda c: c)
    ts = F.col(updated_at)
    cols = [c for c in history.columns if c not in HISTORY_COLUMNS]
    own = [c for c in HISTORY_COLUMNS if c != "valid_to"]
    none = [F.lit(None).cast(history.schema[c].dataType).alias(c) for c in own]
    incoming = incoming.select(*cols)
    hot = _has_hot_key(incoming, keys)
    batch = incoming.select(order_by(ts).alias("_at"), F.lit(False).alias("_open"), *cols, *none)
    open_ = current_rows(history).select(order_by(F.col("valid_from")).alias("_at"), F.lit(True).alias("_open"), *cols, *own)
    both = open_.unionByName(batch)
    both = both if hot else both.repartition(*keys)
    rest = [c for c in (*cols, *own) if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    if tie_break and tie_break in cols:  # an open version is alone in its group
        first_of = F.min_by(packed, F.when(F.col("_open"), F.lit(0).cast(history.schema[tie_break].dataType)).otherwise(F.col(tie_break)))
    else:
        first_of = F.min(packed)
    both = both.groupBy(*keys, "_at", "_open").agg(first_of.alias("_row")).select(*keys, "_at", "_open", *[F.col(f"_row.{c}").alias(c) for c in rest])
    whole = Window.partitionBy(*keys)
    later = F.col("_at").isNotNull() & (F.col("_opened").isNull() | (F.col("_at") > F.col("_opened")))
    line = (both
            .withColumns({"_has_open": F.max("_open").over(whole), "_opened": F.max(F.when(F.col("_open"), F.col("_at"))).over(whole)})
            .filter(F.col("_open") | ~F.col("_has_open") | later))
    line = line.withColumns({c: F.when(F.col("_open"), F.col(c)).otherwise(v) for c, v in
                             {"scd_id": _scd_id(keys, ts), "updated_at": ts, "valid_from": ts}.items()})
    ahead = whole.orderBy(F.col("_at").asc_nulls_first(), F.col("valid_from").asc_nulls_first())
    line = line.withColumn("valid_to", F.lead("valid_from").over(ahead)).select(*history.columns)
    return history.filter(F.col("valid_to").isNotNull()), line


def scd2_line(open_: DataFrame | None, incoming: DataFrame, key: str | Sequence[str], updated_at: str,
              order_by: OrderFn | None = None, tie_break: str = "id") -> DataFrame:
    """The merged time lines of ``scd2_parts`` as ``incoming``'s columns and ``valid_to``, for histories that
    leave out what follows from key and time: only the rows' own columns are moved, once, and sorted once.
    A batch with a key of more than ``HOT_ROWS`` rows is reduced in every task first, as in ``scd2_parts``.
    """
    keys = _keys(key)
    order_by = order_by or (lambda c: c)
    ts, cols = F.col(updated_at), incoming.columns
    rest = [c for c in cols if c not in keys]
    both = incoming.withColumn("_open", F.lit(False))
    if open_ is not None:
        both = open_.select(*cols).withColumn("_open", F.lit(True)).unionByName(both)
    at = order_by(ts).alias("_at")
    back = Window.partitionBy(*keys).orderBy(F.col("_at").desc_nulls_last(), F.col("_open").desc(), F.col(tie_break).asc_nulls_last())
    if _has_hot_key(incoming, keys):
        # an open version is alone in its group
        first_of = F.min_by(F.struct(*rest), F.when(F.col("_open"), F.lit(0).cast(incoming.schema[tie_break].dataType)).otherwise(F.col(tie_break)))
        both = (both.groupBy(*keys, at, "_open").agg(first_of.alias("_row"))
                .select(*keys, "_at", "_open", *[F.col(f"_row.{c}").alias(c) for c in rest]))
    else:
        both = both.repartition(*keys).select("*", at)
        again = F.coalesce(F.lag("_open").over(back) == F.col("_open"), F.lit(False)) & F.lag("_at").over(back).eqNullSafe(F.col("_at"))
        both = both.withColumn("_again", again).filter(~F.col("_again"))
        kept = F.col("_open") | F.col(tie_break).isNotNull()  # as with min_by, a row without tie break is none
        both = both.select(*keys, "_at", "_open", *[F.when(kept, F.col(c)).alias(c) if c != tie_break else F.col(c) for c in rest])
    # from the last time back: rows that come after their key's open version are earlier than it, or of its time
    valid_to = F.lag(ts).over(back).alias("valid_to")
    if open_ is None:
        return both.select(*cols, valid_to)
    not_later = F.max("_open").over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_not_later")
    return both.select(*cols, valid_to, "_open", not_later).filter(F.col("_open") | ~F.col("_not_later")).select(*cols, "valid_to")


def scd2_history(df: DataFrame, key: str | Sequence[str], updated_at: str, order_by: OrderFn | None = None, tie_break: str = "id") -> DataFrame:
    """The history of ``scd2_bulk``, for large inputs: rows are moved once, by key, unless a key has more than
    ``HOT_ROWS`` of them, and not first by key and time and then by key."""
    return scd2_bulk(scd2_line(None, df, key, updated_at, order_by, tie_break), key, updated_at, unique_key=True, valid_to=F.col("valid_to"))


def _has_hot_key(df: DataFrame, keys: list[str]) -> bool:
    """Whether a key has more than ``HOT_ROWS`` rows. Hash groups of keys are counted first, which takes little
    room however many keys there are; single keys are counted only in groups of so many rows."""
    counted = df.select(*keys).withColumn("_g", F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_GROUPS)))
    large = counted.groupBy("_g").agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS)
    groups = [r[0] for r in large.select("_g").limit(1001).collect()]  # bounded
    if not groups:
        return False
    if len(groups) <= 1000:
        counted = counted.filter(F.col("_g").isin(groups))
    return not counted.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ROWS).isEmpty()


def current_rows(df: DataFrame) -> DataFrame:
    """Only the open version of every key."""
    return df.filter(F.col("valid_to").isNull())
