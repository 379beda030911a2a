"""Monthly listing KPIs for any grouping of listing rows.

The neighbourhood and property-type marts compute the same fourteen figures
and differ only in their grouping keys, so they are written once here.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.functions.dates import label_time_key, month_label
from staylake.functions.exact import avg_exact, pct
from staylake.functions.listing import (NIGHTS_WINDOW, active_only, estimated_nights,
                                        flag_count, is_true)
from staylake.operators.windows import period_change

SKETCH_LG_K = 16

KPI_COLUMNS = [
    "active_listings_ratio", "minimum_price", "maximum_price", "median_price",
    "average_price", "distinct_host", "superhost_ratio", "average_review_scores_rating",
    "active_change", "inactive_change", "stays", "avg_estimate_revenue",
]


def monthly_listing_aggregates(rows: DataFrame, keys: Sequence[str],
                               date_col: str = "scraped_date", median: str = "exact") -> DataFrame:
    """One row per (keys, month label) with the additive parts of every KPI.

    The distinct host count is its own aggregate: folded into the main one,
    Spark would compute every other aggregate (median buffers included) at
    (keys, month, host) grain and shuffle those. The two small results, one row
    per group each, are put together by a union and one more aggregate, where
    NULL keys meet without a null-safe join. The exact median keeps a
    price -> count map per group, bounded by the number of distinct prices;
    ``median="selected"`` finds the same value by ``exact_median``, without a map,
    for groups whose distinct prices are too many to hold.
    """
    if median not in ("exact", "selected"):
        raise ValueError("median must be 'exact' or 'selected'")
    active_price = active_only("price")
    median_col = F.percentile(active_price, F.lit(0.5)) if median == "exact" else F.lit(None).cast("double")
    month = month_label(date_col).alias("month_year")
    group = [*keys, "month_year"]
    active = is_true("has_availability")
    inactive = F.col("has_availability") == F.lit(False)
    revenue_or_zero = F.when(
        active, (F.lit(NIGHTS_WINDOW) - F.col("availability_30").cast("bigint"))
        * F.col("price").cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    base = rows.select(*keys, month, "host_id", "host_is_superhost", "price",
                       "has_availability", "availability_30", "review_scores_rating")
    main = base.groupBy(*group).agg(
        flag_count(active).alias("n_active"),
        F.count("has_availability").alias("n_flagged"),
        flag_count(inactive).alias("n_inactive"),
        F.min(active_only("price")).alias("minimum_price"),
        F.max(active_only("price")).alias("maximum_price"),
        median_col.alias("median_price"),
        F.sum(active_only("price").cast("bigint")).alias("sum_active_price"),
        F.count(active_only("price")).alias("n_active_price"),
        flag_count(is_true("host_is_superhost")).alias("n_superhost"),
        F.count("host_is_superhost").alias("n_superhost_flagged"),
        F.sum(active_only("review_scores_rating").cast("bigint")).alias("sum_active_rating"),
        F.count(active_only("review_scores_rating")).alias("n_active_rating"),
        F.sum(estimated_nights()).alias("stays"),
        F.sum(revenue_or_zero).alias("sum_revenue_or_zero"),
        F.count(revenue_or_zero).alias("n_revenue_or_zero"),
    )
    hosts = distinct_count(base, group, "host_id", "distinct_host")
    figures = [c for c in main.columns if c not in group]
    both = main.unionByName(hosts, allowMissingColumns=True)  # at most one value of a figure per group
    if median == "selected":
        priced = base.filter(active).select(*group, "price")
        both = both.unionByName(exact_median(priced, group, "price", "median_price"), allowMissingColumns=True)
    return both.groupBy(*group).agg(*[F.max(c).alias(c) for c in figures],
                                    F.coalesce(F.max("distinct_host"), F.lit(0).cast("bigint")).alias("distinct_host"))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", low_bits: int = 12) -> DataFrame:
    """The median of an integer column per ``keys`` (the mean of the two middle values), by selection in two passes.

    First the values are counted by their upper bits, which finds the one or two ranges that hold the
    middle; then only rows in these are counted by value. Both counts are partially aggregated,
    so a group of any size shrinks in every task, and nothing holds a group's values: a task sees
    one row per range of a group, and at most 2 ** ``low_bits`` values of a range. Groups without a value are left out;
    keys may be NULL.
    """
    df = df.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("_group"), F.col(value).cast("bigint").alias("_v"))

    def ranked(counts: DataFrame, part: list[str], offset: Column) -> DataFrame:
        """Adds the first and last rank of each unit within ``part``."""
        before = Window.partitionBy(*part).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
        return (counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)) + offset)
                .withColumn("_last", F.col("_first") + F.col("_n") - 1))

    ranges = df.groupBy("_group", F.shiftright("_v", low_bits).alias("_unit")).agg(F.count("*").alias("_n"))
    ranges = ranked(ranges, ["_group"], F.lit(0)).withColumn("_total", F.sum("_n").over(Window.partitionBy("_group")))
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    holds = lambda rank: rank.between(F.col("_first"), F.col("_last"))
    middle = ranges.filter(holds(low) | holds(high)).select("_group", F.col("_unit").alias("_range"), F.col("_first").alias("_offset"), "_total")
    inside = df.withColumn("_range", F.shiftright("_v", low_bits)).join(middle, ["_group", "_range"])
    counts = inside.groupBy("_group", "_range", "_offset", "_total", F.col("_v").alias("_unit")).agg(F.count("*").alias("_n"))
    counts = ranked(counts, ["_group", "_range"], F.col("_offset"))
    both = counts.groupBy("_group").agg(F.max(F.when(holds(low), F.col("_unit"))).alias("_a"), F.max(F.when(holds(high), F.col("_unit"))).alias("_b"))
    return both.select("_group.*", ((F.col("_a") + F.col("_b")) / 2).alias(out))


def host_sketches(rows: DataFrame, keys: Sequence[str], date_col: str = "scraped_date", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per ``keys`` and month a mergeable state of the distinct hosts, next to their exact count."""
    group = [*keys, "month_year"]
    base = rows.select(*keys, month_label(date_col).alias("month_year"), "host_id")
    states = base.groupBy(*group).agg(F.hll_sketch_agg("host_id", F.lit(lg_k)).alias("hosts"))
    exact = distinct_count(base, group, "host_id", "distinct_host")
    both = states.unionByName(exact, allowMissingColumns=True)
    return both.groupBy(*group).agg(F.max("hosts").alias("hosts"), F.coalesce(F.max("distinct_host"), F.lit(0).cast("bigint")).alias("distinct_host"))


def merged_hosts(sketches: DataFrame, keys: Sequence[str], out: str = "distinct_host_estimate") -> DataFrame:
    """Distinct hosts over several months: states add up where counts do not. The relative standard error
    is about 1.04 / sqrt(2 ** lg_k), 0.4 % by default; a month's own count stays exact."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("hosts")).alias(out))


def distinct_count(df: DataFrame, group: Sequence[str], col: str, out: str) -> DataFrame:
    """Exact ``COUNT(DISTINCT col)`` per group: distinct (group, col) pairs
    (partial-aggregated), then a count per group."""
    return (df.select(*group, col).filter(F.col(col).isNotNull()).distinct()
            .groupBy(*group).agg(F.count("*").alias(out)))


def listing_kpis(rows: DataFrame, keys: Sequence[str], date_col: str = "scraped_date",
                 order: str = "label", median: str = "exact") -> DataFrame:
    """The fourteen monthly KPI columns per ``keys``.

    ``order="label"`` ranks months by their ``MM/yyyy`` text (the models'
    behaviour: ``01/2021`` comes before ``05/2020``); ``order="time"`` ranks
    them by date. The change columns compare a month with the next one in
    that order within the same ``keys``.
    """
    return finished_kpis(monthly_listing_aggregates(rows, keys, date_col, median), keys, order)


def finished_kpis(agg: DataFrame, keys: Sequence[str], order: str = "label") -> DataFrame:
    """The KPI columns from monthly aggregates, one row per ``keys`` and month."""
    agg = agg.withColumn("_month_order", F.col("month_year") if order == "label"
                         else label_time_key("month_year"))
    agg = period_change(agg, "n_active", keys, "_month_order", "active_change", denom="n_active")
    agg = period_change(agg, "n_inactive", keys, "_month_order", "inactive_change", denom="n_active")
    return agg.select(
        *keys, "month_year",
        pct("n_active", "n_flagged").alias("active_listings_ratio"),
        "minimum_price", "maximum_price", "median_price",
        avg_exact("sum_active_price", "n_active_price").alias("average_price"),
        "distinct_host",
        pct("n_superhost", "n_superhost_flagged").alias("superhost_ratio"),
        avg_exact("sum_active_rating", "n_active_rating").alias("average_review_scores_rating"),
        "active_change", "inactive_change", "stays",
        avg_exact("sum_revenue_or_zero", "n_revenue_or_zero").alias("avg_estimate_revenue"),
    )
