"""One host holding a third of all rows: results stay exact and every
shuffle keyed by host carries pre-aggregated rows, not raw rows."""

import pytest
from pyspark.sql import functions as F

from staylake.functions.exact import pct, ratio
from staylake.functions.listing import estimated_revenue
from staylake.functions.text import fold, lga_code_parse
from staylake.operators.joins import assemble
from staylake.plans import questions
from staylake.plans.warehouse import Warehouse
from staylake.sources import fixtures
from tests.conftest import SMOKE_DIR
from tests.helpers import rows_of

KIND = ["property_type", "room_type", "accommodates"]


@pytest.fixture(scope="module")
def hot(spark):
    raw = fixtures.raw_tables(spark, SMOKE_DIR)
    raw["house"] = raw["house"].withColumn(
        "host_id", F.when(F.col("id") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("host_id")))
    return Warehouse(raw)


def _naive_room_counts(wh):
    trio = assemble({"h": wh.dim_host(), "l": wh.dim_listing().select("id"), "p": wh.dim_property()})
    room_table = trio.select("host_id", *KIND).distinct()
    return room_table.filter(F.col("host_id").isNotNull()).groupBy("host_id").count()


def test_q3_exact_under_skew(spark, hot):
    multi = _naive_room_counts(hot).filter("count > 1").select("host_id")
    lga = hot.dim_lga()
    host_area = (hot.dim_host().join(multi, "host_id", "left_semi")
                 .join(lga, fold(F.col("host_neighbourhood")) == fold(F.col("suburb_name")))
                 .select("id", F.col("lga_name").alias("host_lga")))
    listing_area = (hot.dim_listing().join(lga, fold(F.col("listing_neighbourhood")) == fold(F.col("suburb_name")))
                    .select("id", F.col("lga_name").alias("listing_lga")))
    local = F.when(F.col("host_lga") == F.col("listing_lga"), 1).otherwise(0)
    naive = (host_area.join(listing_area, "id").groupBy("host_lga")
             .agg(F.count("*").alias("total_listings"), F.sum(local).alias("local_listings"))
             .withColumn("local_rate", pct("local_listings", "total_listings")))
    assert rows_of(questions.q3_local_rate(hot)) == rows_of(naive.select(*questions.q3_local_rate(hot).columns))


def test_q4_exact_under_skew(spark, hot):
    single = _naive_room_counts(hot).filter("count = 1").select("host_id")
    trio = assemble({"h": hot.dim_host(), "l": hot.dim_listing(), "p": hot.dim_property()})
    host_area = (single.join(trio, "host_id").groupBy("host_id", "host_name", "listing_neighbourhood")
                 .agg(F.sum(estimated_revenue()).alias("estimate_revenue")))
    repay = hot.fact_two().select(lga_code_parse("lga_code_2016").alias("lga_code"),
                                  F.col("median_mortgage_repay_monthly").alias("monthly_repay"))
    rt = host_area.join(hot.dim_lga().join(repay, "lga_code"),
                        fold(F.col("listing_neighbourhood")) == fold(F.col("suburb_name")))
    covers = F.when(F.col("estimate_revenue") > F.col("monthly_repay") * 12, 1).otherwise(0)
    naive = rt.agg(ratio(F.sum(covers), F.count("*")).alias("covered"))
    assert rows_of(questions.q4_mortgage_cover(hot)) == rows_of(naive)
    assert rows_of(questions.single_host_revenue(hot)) == rows_of(host_area)


def _host_exchanges_are_fed_by_aggregates(plan: str) -> int:
    lines = [l.strip(" :+-|") for l in plan.splitlines()]
    checked = 0
    for i, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning(host_id"):
            checked += 1
            assert "Aggregate" in lines[i + 1], f"raw rows shuffled by host: {lines[i + 1]}"
    return checked


def test_host_shuffles_carry_aggregates(spark, hot):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (questions.q3_local_rate(hot), questions.q4_mortgage_cover(hot)):
            assert _host_exchanges_are_fed_by_aggregates(df._jdf.queryExecution().executedPlan().toString()) > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
