"""Month-by-month marts, selected medians, merged distinct hosts, salted joins."""

import random

import pytest
from pyspark.sql import functions as F

from staylake.operators.joins import fold_join, salted_fold_join
from staylake.operators.kpi import (distinct_count, exact_median, host_sketches, listing_kpis, merged_hosts,
                                    monthly_listing_aggregates)
from staylake.plans.incremental import KpiMart
from staylake.session import scratch_path
from tests.helpers import house, rows_of

KEYS = ["listing_neighbourhood"]


def _listings(spark, seed=1, n=200):
    rnd = random.Random(seed)
    rows = [{"scraped_date": f"20{rnd.choice((20, 21))}-{rnd.choice((1, 2, 5, 12)):02d}-03", "listing_neighbourhood": rnd.choice(["a", "b", None, "c"]),
             "price": rnd.choice([None, *range(6, 40)]), "has_availability": rnd.random() < 0.7, "host_id": rnd.randrange(20)} for _ in range(n)]
    # "rare" has rows in two months only, so its next month is not the next month of others
    rows += [{"scraped_date": d, "listing_neighbourhood": "rare"} for d in ("2020-01-03", "2021-12-03", "2021-12-04")]
    return house(spark, rows).withColumn("scraped_date", F.to_date("scraped_date"))


@pytest.mark.parametrize("order", ["label", "time"])
def test_months_in_any_order_equal_the_full_build(spark, order):
    rows = _listings(spark)
    months = [r[0] for r in rows.select(F.trunc("scraped_date", "month").cast("string")).distinct().collect()]
    random.Random(2).shuffle(months)
    of = lambda *m: rows.filter(F.trunc("scraped_date", "month").cast("string").isin(*m))
    mart = KpiMart(spark, scratch_path(spark, "mart-test"), KEYS, order)
    assert mart.read() is None and mart.load(rows.limit(0)) == []
    mart.load(of(months[0]).withColumn("has_availability", F.lit(False)))  # replaced by the next load
    for m in months:
        mart.load(of(m))
    whole = listing_kpis(rows, KEYS, order=order)
    assert rows_of(mart.read(), *whole.columns) == rows_of(whole)
    # a month without "rare" takes its row away, and the month before it that looked ahead to it is rewritten
    again = mart.load(of("2021-12-01").filter("listing_neighbourhood <> 'rare'"))
    left = rows.filter("NOT (listing_neighbourhood <=> 'rare' AND scraped_date > '2021-12-01')")
    left = left.filter("scraped_date < '2021-12-01' OR listing_neighbourhood IS NOT NULL")
    assert rows_of(mart.read(), *whole.columns) == rows_of(listing_kpis(left, KEYS, order=order))
    assert "12/2021" in again and "01/2020" in again and len(again) < len(months)


def test_selected_median_equals_percentile(spark):
    rnd = random.Random(5)
    rows = [("hot", rnd.choice((7, 8, 10 ** 6, -5 * 10 ** 6))) for _ in range(5000)]
    rows += [(f"g{i % 9}", rnd.randrange(-10 ** 10, 10 ** 10)) for i in range(700)] + [(None, 3), (None, 4), ("one", 2 ** 40), ("none", None), ("same", 9), ("same", 9)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    expected = df.filter("v IS NOT NULL").groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("median"))
    for bits in (1, 12, 33):
        assert rows_of(exact_median(df, ["k"], "v", low_bits=bits)) == rows_of(expected)
    assert exact_median(df.limit(0), ["k"], "v").count() == 0
    listings = _listings(spark)
    both = [rows_of(monthly_listing_aggregates(listings, KEYS, median=m)) for m in ("exact", "selected")]
    assert both[0] == both[1]


def test_merged_hosts_are_close(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("area"), F.expr("CAST(DATE'2021-01-01' + INT(id % 300) AS DATE)").alias("scraped_date"),
                                      (F.col("id") % 17_011).alias("host_id"))
    states = host_sketches(rows, ["area"])
    own = distinct_count(rows.withColumn("month_year", F.date_format("scraped_date", "MM/yyyy")), ["area", "month_year"], "host_id", "n")
    assert rows_of(states, "area", "month_year", "distinct_host") == rows_of(own, "area", "month_year", "n")  # exact per month
    exact = {r.area: r.n for r in distinct_count(rows, ["area"], "host_id", "n").collect()}
    merged = {r.area: r.distinct_host_estimate for r in merged_hosts(states, ["area"]).collect()}
    assert exact.keys() == merged.keys() and all(abs(merged[a] - n) <= 0.0163 * n for a, n in exact.items())
    summed = {r.area: r.n for r in states.groupBy("area").agg(F.sum("distinct_host").alias("n")).collect()}
    assert all(summed[a] > 1.1 * n for a, n in exact.items())  # counts of months do not add up


def test_salted_join_equals_the_plain_one(spark):
    rows = [(i, random.Random(i).choice(["Bondi", "BONDI", "rare", None, "nowhere"])) for i in range(400)] + [(1000, None)] * 3
    left = spark.createDataFrame(rows, "id bigint, suburb string")
    right = spark.createDataFrame([("x", "bondi"), ("y", "Bondi"), ("z", "Rare"), ("n", None)], "lga string, name string")
    for how in ("inner", "left"):
        for hot in (10, 10 ** 6):
            assert rows_of(salted_fold_join(left, right, "suburb", "name", how, hot_rows=hot)) == rows_of(fold_join(left, right, "suburb", "name", how))
    with pytest.raises(ValueError):
        salted_fold_join(left, right, "suburb", "name", "full")


def test_salted_join_bounds_the_largest_task(spark):
    left = spark.range(20_000).withColumn("suburb", F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")))
    right = spark.createDataFrame([("x", "HOT"), ("y", "5")], "lga string, name string").hint("merge")
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        largest = []
        for joined in (fold_join(left, right, "suburb", "name"), salted_fold_join(left, right, "suburb", "name", hot_rows=500)):
            largest.append(max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest[0] >= 18_000 and largest[1] < 4_000
