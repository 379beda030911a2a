"""Monthly marts (M14-M16).

``sort=True`` adds the models' output order; it costs a range-partitioned
sort, so it belongs at the final read only (a written table keeps no order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.dates import month_label
from staylake.functions.exact import ratio
from staylake.functions.listing import estimated_revenue
from staylake.operators.joins import fold_join
from staylake.operators.kpi import listing_kpis
from staylake.plans.warehouse import Warehouse

PROPERTY_KEYS = ["property_type", "room_type", "accommodates"]


def dm_host_neighbourhood(wh: Warehouse, sort: bool = False) -> DataFrame:
    """Per host LGA and month: distinct hosts, estimated revenue, revenue per host."""
    rows = wh.rows(host=True, listing=True, property=True)
    j = fold_join(rows, wh.lga_lookup(), "host_neighbourhood", "suburb_name")
    out = (j.groupBy(F.col("lga_name").alias("host_neighbourhood_lga"),
                     month_label("scraped_date").alias("month_year"))
           .agg(F.count_distinct("host_id").alias("distinct_host"),
                F.sum(estimated_revenue()).alias("estimate_revenue"))
           .withColumn("per_host_estimate_revenue", ratio("estimate_revenue", "distinct_host")))
    return out.orderBy("host_neighbourhood_lga", "month_year") if sort else out


def dm_listing_neighbourhood(wh: Warehouse, order: str = "label", sort: bool = False) -> DataFrame:
    """Monthly KPIs per listing neighbourhood."""
    rows = wh.rows(host=True, listing=True, property=True, review=True)
    out = listing_kpis(rows, ["listing_neighbourhood"], order=order)
    return out.orderBy("listing_neighbourhood", "month_year") if sort else out


def dm_property_type(wh: Warehouse, order: str = "label", sort: bool = False) -> DataFrame:
    """Monthly KPIs per (property type, room type, accommodates). The change
    columns compare months within all three keys, so there is one row per
    month in every window partition."""
    rows = wh.rows(host=True, listing=True, property=True, review=True)
    out = listing_kpis(rows, PROPERTY_KEYS, order=order)
    return out.orderBy(*PROPERTY_KEYS, "month_year") if sort else out
