"""The four business questions (M17-M20) and their building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.exact import pct, ratio
from staylake.functions.listing import estimated_nights, estimated_revenue
from staylake.functions.text import fold, lga_code_parse
from staylake.operators.hosts import host_room_spread, hosts_by_kinds
from staylake.operators.joins import fold_join
from staylake.operators.windows import first_last, rank_key, top1_per_group, top_k
from staylake.plans.warehouse import Warehouse
from staylake.sources.store import materialize

# ---- fixed values: census age bands (male columns, as the question uses) ---
UNDER_20_BANDS = ["age_0_4_yr", "age_5_14_yr", "age_15_19_yr"]
BANDS_20_34 = ["age_20_24_yr", "age_25_34_yr"]

TOP_NEIGHBOURHOODS = 5
ROOM_KIND = ["property_type", "room_type", "accommodates"]


def _sum_cols(cols: list[str]):
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out


def age_bands(census: DataFrame, sex: str = "m") -> DataFrame:
    """Population under 20, under 35 and the 20-34 share of under-35s per LGA."""
    under20 = _sum_cols([f"{b}_{sex}" for b in UNDER_20_BANDS])
    mid = _sum_cols([f"{b}_{sex}" for b in BANDS_20_34])
    under35 = _sum_cols([f"{b}_{sex}" for b in UNDER_20_BANDS + BANDS_20_34])
    return census.select(
        lga_code_parse("lga_code_2016").alias("lga_code"),
        under20.alias("population_under_20"),
        under35.alias("population_under_35"),
        pct(mid, under35).alias("rate_20_34"))


def neighbourhood_revenue(wh: Warehouse) -> DataFrame:
    """Estimated revenue per listing neighbourhood (listing JOIN property)."""
    return (wh.rows(listing=True, property=True)
            .groupBy("listing_neighbourhood")
            .agg(F.sum(estimated_revenue()).alias("estimate_revenue")))


def lga_population(wh: Warehouse) -> DataFrame:
    return wh.lga_lookup().join(age_bands(wh.fact_one()), "lga_code")


Q1_COLUMNS = ["lga_name", "listing_neighbourhood", "population_under_20",
              "population_under_35", "rate_20_34", "estimate_revenue"]
Q1_ORDER = [("estimate_revenue", True), ("population_under_35", True),
            ("lga_name", False), ("listing_neighbourhood", False)]


def area_revenue(wh: Warehouse) -> DataFrame:
    """Neighbourhood revenue next to its LGA's population profile."""
    return fold_join(neighbourhood_revenue(wh), lga_population(wh),
                     "listing_neighbourhood", "suburb_name").select(*Q1_COLUMNS)


def q1_best_worst(wh: Warehouse) -> DataFrame:
    """Best and worst neighbourhood by estimated revenue (ties broken by
    population under 35, then names)."""
    return first_last(area_revenue(wh), Q1_ORDER)


def with_total_rows(df: DataFrame) -> DataFrame:
    """``COUNT(*) OVER ()``: the result, one row per group, is written once and counted from there, so
    neither a single-partition window nor a second run of its plan is needed."""
    kept = materialize(df.sparkSession, {"result": df}, "total-rows")["result"]
    return kept.withColumn("total_rows", F.lit(kept.count()).cast("bigint"))


def room_revenue_stays(wh: Warehouse) -> DataFrame:
    """Revenue and stays per (neighbourhood, property, room, accommodates)
    over the listing fact, whose LGA fan-out is kept: the sums are taken before
    the lookup and multiplied by the number of LGAs of the suburb (left join:
    a neighbourhood without one counts once)."""
    rows = wh.rows(host=True, listing=True, property=True)
    sums = (rows.groupBy("listing_neighbourhood", *ROOM_KIND)
            .agg(F.sum(estimated_revenue()).alias("estimate_revenue"),
                 F.sum(estimated_nights()).alias("stays")))
    fan = (wh.lga_lookup().filter(F.col("suburb_name").isNotNull())
           .groupBy(fold(F.col("suburb_name")).alias("suburb")).agg(F.count("*").alias("n_lga")))
    times = F.coalesce("n_lga", F.lit(1).cast("bigint"))
    return (fold_join(sums, fan, "listing_neighbourhood", "suburb", "left")
            .select("listing_neighbourhood", *ROOM_KIND,
                    *[(F.col(c) * times).alias(c) for c in ("estimate_revenue", "stays")]))


def top_neighbourhoods(rooms: DataFrame, k: int = TOP_NEIGHBOURHOODS) -> DataFrame:
    by_nb = rooms.groupBy("listing_neighbourhood").agg(
        F.sum("estimate_revenue").alias("estimate_revenue"))
    return top_k(by_nb, k, [("estimate_revenue", True), ("listing_neighbourhood", False)])


BEST_ROOM = [("stays", True), ("property_type", False), ("room_type", False), ("accommodates", False)]


def best_room_per_neighbourhood(rooms: DataFrame) -> DataFrame:
    return top1_per_group(rooms, ["listing_neighbourhood"], BEST_ROOM)


def q2_best_type(wh: Warehouse, sort: bool = False) -> DataFrame:
    """In the five top-revenue neighbourhoods, the (property, room,
    accommodates) with the most stays.

    One aggregate of the listings, then one per neighbourhood that carries both
    its total revenue and its best room kind (``min_by``, partially aggregated, so a
    neighbourhood with very many kinds is not gathered in a task); the top five of those rows are kept. The listings are scanned
    once, with no join back and no window. A NULL neighbourhood still takes a top-five place but is not
    reported (the original joins the top five back on the name). ``sort`` puts
    the most stays first, as the question does.
    """
    rooms = room_revenue_stays(wh)
    kinds = (rooms.groupBy("listing_neighbourhood")
             .agg(F.sum("estimate_revenue").alias("nb_revenue"),
                  F.min_by(F.struct(*ROOM_KIND, "stays"), rank_key(rooms, BEST_ROOM)).alias("best")))
    top = top_k(kinds, TOP_NEIGHBOURHOODS, [("nb_revenue", True), ("listing_neighbourhood", False)])
    out = top.filter(F.col("listing_neighbourhood").isNotNull()).select("listing_neighbourhood", "best.*")
    return out.orderBy(F.col("stays").desc_nulls_last(), "listing_neighbourhood") if sort else out


def host_room_types(wh: Warehouse) -> DataFrame:
    """Distinct (host, property, room, accommodates) over host JOIN listing JOIN property."""
    return wh.rows(host=True, listing=True, property=True).select("host_id", *ROOM_KIND).distinct()


def host_spread(wh: Warehouse) -> DataFrame:
    return host_room_spread(wh.rows(host=True, listing=True, property=True), "host_id", ROOM_KIND)


def hosts_multi(wh: Warehouse) -> DataFrame:
    return host_spread(wh).filter(F.col("multi")).select("host_id")


def hosts_single(wh: Warehouse) -> DataFrame:
    return host_spread(wh).filter(~F.col("multi")).select("host_id")


def q3_local_rate(wh: Warehouse, sort: bool = False) -> DataFrame:
    """For hosts with several room types: per host LGA, the share of their
    listings in that same LGA.

    Rows are first reduced to counts per (host, host suburb, listing suburb, room kind), so
    a host with very many listings shrinks map-side; a window per host over these counts
    tells whether its rooms are of several kinds, so the listings are scanned once.
    Both suburb lookups are broadcast; summing the counts over the looked-up
    rows reproduces ``COUNT(*)`` of the row-level join, fan-out included.
    """
    priced = wh.rows(host=True, listing=True, kind=True)
    pairs = (priced.groupBy("host_id", "host_neighbourhood", "listing_neighbourhood", "kind")
             .agg(F.count("*").alias("n")))
    pairs = hosts_by_kinds(pairs, "host_id", "kind", multi=True)
    lga = wh.lga_lookup()
    h = lga.select(F.col("lga_name").alias("host_lga"), F.col("suburb_name").alias("h_suburb"))
    l = lga.select(F.col("lga_name").alias("listing_lga"), F.col("suburb_name").alias("l_suburb"))
    j = (pairs.join(h, fold(F.col("host_neighbourhood")) == fold(F.col("h_suburb")))
         .join(l, fold(F.col("listing_neighbourhood")) == fold(F.col("l_suburb"))))
    local = F.col("host_lga") == F.col("listing_lga")
    out = (j.groupBy("host_lga")
           .agg(F.sum("n").alias("total_listings"),
                F.sum(F.when(local, F.col("n")).otherwise(0)).alias("local_listings"))
           .withColumn("local_rate", pct("local_listings", "total_listings")))
    return out.orderBy(F.col("local_rate").desc_nulls_last(), "host_lga") if sort else out


def mortgage_repayments(wh: Warehouse) -> DataFrame:
    return wh.fact_two().select(lga_code_parse("lga_code_2016").alias("lga_code"),
                                F.col("median_mortgage_repay_monthly").alias("monthly_repay"))


def single_host_revenue(wh: Warehouse) -> DataFrame:
    """Estimated revenue per (single-type host, name, listing neighbourhood).

    Rows collapse to (host, name, neighbourhood, room kind) sums first; a window per
    host over that smaller aggregate makes the single-type test, and the final sums need no further shuffle.
    """
    combos = (wh.rows(host=True, listing=True, property=True)
              .groupBy("host_id", "host_name", "listing_neighbourhood", F.struct(*ROOM_KIND).alias("kind"))
              .agg(F.sum(estimated_revenue()).alias("rev")))
    return (hosts_by_kinds(combos, "host_id", "kind", multi=False)
            .groupBy("host_id", "host_name", "listing_neighbourhood")
            .agg(F.sum("rev").alias("estimate_revenue")))


def q4_mortgage_cover(wh: Warehouse) -> DataFrame:
    """Share of (single-type host, neighbourhood) rows whose estimated
    revenue exceeds a year of the LGA's median mortgage repayment."""
    repay_by_suburb = wh.lga_lookup().join(mortgage_repayments(wh), "lga_code")
    rt = fold_join(single_host_revenue(wh), repay_by_suburb, "listing_neighbourhood", "suburb_name")
    covers = F.col("estimate_revenue") > F.col("monthly_repay") * 12
    return rt.agg(ratio(F.sum(F.when(covers, 1).otherwise(0)), F.count("*")).alias("covered"))
