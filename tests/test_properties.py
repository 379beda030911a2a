"""Property checks on generated and fixture data."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from staylake.functions.exact import pct, ratio
from staylake.operators.kpi import listing_kpis, monthly_listing_aggregates
from staylake.plans.warehouse import Warehouse
from staylake.sources import fixtures
from tests.conftest import SMOKE_DIR


def _decimal_round(a: int, b: int, scale: int) -> float | None:
    if b == 0:
        return None
    q = Decimal(a) / Decimal(b) * (Decimal(10) ** scale)
    return float(q.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))  # half away from zero


def test_exact_rounding_matches_decimal(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(-10 ** 9, 10 ** 9), rnd.choice([0, 1, 2, 3, 7, 8, 16, 40, 125, 999, rnd.randint(1, 10 ** 6)]))
             for _ in range(3000)]
    pairs += [(k, 8) for k in range(-20, 21)] + [(k, 400) for k in range(-5, 6)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", pct("a", "b").alias("p"), ratio("a", "b").alias("r")).collect()
    for row in got:
        assert row.p == _decimal_round(row.a, row.b, 2), row
        assert row.r == _decimal_round(row.a, row.b, 0), row


def _one_year(spark, year: str) -> Warehouse:
    raw = fixtures.raw_tables(spark, SMOKE_DIR)
    raw["house"] = raw["house"].filter(F.col("scraped_date").startswith(year))
    return Warehouse(raw)


def test_time_order_equals_label_order_within_a_year(spark):
    wh = _one_year(spark, "1997")
    rows = wh.rows(host=True, listing=True, property=True, review=True)
    label = listing_kpis(rows, ["listing_neighbourhood"], order="label")
    time = listing_kpis(rows, ["listing_neighbourhood"], order="time")
    assert label.count() > 0
    assert label.exceptAll(time).count() == 0 and time.exceptAll(label).count() == 0


def test_month_totals_add_up_to_the_scan(spark):
    wh = Warehouse(fixtures.raw_tables(spark, SMOKE_DIR))
    rows = wh.rows(host=True, listing=True, property=True, review=True)
    monthly = monthly_listing_aggregates(rows, ["listing_neighbourhood"])
    totals = monthly.agg(F.sum("n_flagged"), F.sum("stays"), F.sum("n_active")).first()
    direct = rows.agg(F.count("has_availability"),
                      F.sum(F.when(F.col("has_availability"), 30 - F.col("availability_30")).otherwise(0)),
                      F.sum(F.when(F.col("has_availability"), 1).otherwise(0))).first()
    assert tuple(totals) == tuple(direct)


def test_incremental_history_equals_bulk_random(spark):
    """Random updates arriving in time order, at most one row per key per
    batch: merging batch by batch gives the bulk history (SURVEY 5.4)."""
    from staylake.operators.history import current_rows, scd2_bulk, scd2_merge

    rnd = random.Random(11)
    batches, rid = [], 0
    for day in range(1, 7):
        rows = []
        for key in rnd.sample(range(25), 12):
            rid += 1
            rows.append((rid, key, f"2021-01-{day:02d}", f"v{rid}"))
        batches.append(rows)
    ddl = "id long, k long, d string, v string"
    history = scd2_bulk(spark.createDataFrame(batches[0], ddl), "k", "d", unique_key=True)
    for b in batches[1:]:
        history = scd2_merge(history, spark.createDataFrame(b, ddl), "k", "d")
    bulk = scd2_bulk(spark.createDataFrame([r for b in batches for r in b], ddl), "k", "d")
    cols = ["id", "k", "d", "v", "scd_id", "valid_from", "valid_to"]
    assert history.select(*cols).exceptAll(bulk.select(*cols)).count() == 0
    assert bulk.select(*cols).exceptAll(history.select(*cols)).count() == 0
    assert current_rows(history).count() == len({r[1] for b in batches for r in b})


def test_selected_median_is_exact(spark):
    from staylake.operators.kpi import monthly_listing_aggregates

    rows = Warehouse(fixtures.raw_tables(spark, SMOKE_DIR)).rows(host=True, listing=True, property=True, review=True)
    exact, selected = (monthly_listing_aggregates(rows, ["listing_neighbourhood"], median=m) for m in ("exact", "selected"))
    assert exact.exceptAll(selected).count() == 0 and selected.exceptAll(exact).count() == 0
