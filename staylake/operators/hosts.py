"""Host-level room-type spread: does a host offer one kind of room or several?"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROOM_KIND = ("property_type", "room_type", "accommodates")


def host_room_spread(rows: DataFrame, host: str = "host_id",
                     kind: Sequence[str] = ROOM_KIND) -> DataFrame:
    """One row per non-NULL host: ``n_kinds`` distinct ``kind`` combinations
    (NULL counts as a value, as in GROUP BY) and ``multi = n_kinds > 1``.

    Two hash aggregates: distinct (host, kind) pairs, partial-aggregated in
    every task (a host with very many rows shrinks to its few kinds before
    the shuffle), then a count per host.
    """
    pairs = rows.filter(F.col(host).isNotNull()).select(host, *kind).distinct()
    return (pairs.groupBy(host).agg(F.count("*").alias("n_kinds"))
            .withColumn("multi", F.col("n_kinds") > 1))


def restrict_hosts(df: DataFrame, spread: DataFrame, multi: bool, host: str = "host_id") -> DataFrame:
    """Keep the rows of ``df`` whose host is (not) multi-kind.

    Written as an inner join with the one-row-per-host flags rather than a
    semi join: Catalyst pushes a semi join below an aggregate on the same key,
    which would shuffle raw rows by host instead of the pre-aggregated ones.
    """
    keep = spread.filter(F.col("multi") if multi else ~F.col("multi")).select(host)
    return df.join(keep, host)


def hosts_by_kinds(sums: DataFrame, host: str, kind: str, multi: bool) -> DataFrame:
    """Rows of hosts with several (``multi``) or exactly one ``kind``, a struct column; a NULL
    struct is no kind, NULL fields are values. NULL hosts are left out.

    One window over ``sums``, which should be pre-aggregated by host and kind: the smallest
    and the largest kind of a host differ if it has several. Nothing is read or shuffled
    twice, and a host's rows stay where the window put them for later sums by host.
    """
    own = Window.partitionBy(host)
    marked = sums.filter(F.col(host).isNotNull()).withColumns({"_low": F.min(kind).over(own), "_high": F.max(kind).over(own)})
    same = F.col("_low") == F.col("_high")
    return marked.filter(F.col("_low").isNotNull() & (~same if multi else same)).drop("_low", "_high")
