from pyspark.sql import functions as F

from staylake.operators.joins import assemble
from staylake.plans import marts, questions
from staylake.plans.warehouse import Warehouse
from tests.conftest import SMOKE_DIR
from tests.helpers import rows_of, warehouse


def test_staging_filters(spark):
    wh = warehouse(spark, [
        {"host_name": ""}, {"host_name": None}, {"host_since": ""}, {},
        {"price": 5}, {"price": 6}, {"price": None},
    ])
    assert sorted(r.id for r in wh.stg_host().collect()) == [4, 5, 6, 7]
    assert sorted(r.id for r in wh.stg_property().collect()) == [1, 2, 3, 4, 6]
    assert wh.stg_listing().count() == 7
    # the fused row set keeps exactly the ids both filters keep
    assert sorted(r.id for r in wh.rows(host=True, property=True).collect()) == [4, 6]


def test_host_since_parsed_unpadded(spark):
    wh = warehouse(spark, [{"host_since": "7/1/2013"}, {"host_since": "27/11/2013"}, {"host_since": "x"}])
    got = {r.id: r.host_since for r in wh.stg_host().collect()}
    assert str(got[1]) == "2013-01-07" and str(got[2]) == "2013-11-27" and got[3] is None


def test_suburb_in_two_lgas_fans_out(spark):
    suburbs = [(1, "Waverley", "Bondi"), (2, "Sydney", "BONDI")]
    wh = warehouse(spark, [{"listing_neighbourhood": "Bondi"}, {"listing_neighbourhood": "Nowhere"}],
                   suburbs=suburbs)
    fl = wh.fact_listing()
    assert fl.count() == 3  # Bondi twice, Nowhere once with NULL LGA
    assert fl.filter(F.col("listing_neighbourhood_lga").isNull()).count() == 1


def test_all_inactive_group(spark):
    wh = warehouse(spark, [{"has_availability": False}, {"has_availability": False, "price": 50}])
    m = marts.dm_listing_neighbourhood(wh).collect()
    assert len(m) == 1
    r = m[0]
    assert r.minimum_price is None and r.median_price is None and r.average_price is None
    assert r.active_listings_ratio == 0.0 and r.active_change is None and r.inactive_change is None
    assert r.stays == 0 and r.avg_estimate_revenue == 0.0 and r.distinct_host == 1


def test_months_change_in_label_and_time_order(spark):
    rows = [{"scraped_date": "2020-12-05"}, {"scraped_date": "2021-01-05"},
            {"scraped_date": "2021-01-06"}]
    wh = warehouse(spark, rows)
    label = {r.month_year: r.active_change for r in marts.dm_listing_neighbourhood(wh).collect()}
    time = {r.month_year: r.active_change for r in marts.dm_listing_neighbourhood(wh, order="time").collect()}
    # label order: 01/2021 then 12/2020; time order: 12/2020 then 01/2021
    assert label == {"01/2021": -50.0, "12/2020": None}
    assert time == {"12/2020": 100.0, "01/2021": None}


def test_null_availability_counts(spark):
    wh = warehouse(spark, [{"has_availability": None}, {"has_availability": True}, {"availability_30": None}])
    r = marts.dm_listing_neighbourhood(wh).collect()[0]
    assert r.active_listings_ratio == 100.0  # COUNT(has_availability) ignores NULL
    assert r.stays == 20                      # NULL availability contributes nothing


def test_q1_single_row_and_ties(spark):
    one = warehouse(spark, [{}])
    assert questions.q1_best_worst(one).count() == 1
    two = warehouse(spark, [{"listing_neighbourhood": "Bondi"}, {"listing_neighbourhood": "Surry Hills"}])
    got = rows_of(questions.q1_best_worst(two), "listing_neighbourhood")
    assert got == [("bondi",), ("surry hills",)]


def test_q2_ties_broken_on_kind(spark):
    rows = [{"property_type": "B"}, {"property_type": "A"}]
    got = questions.q2_best_type(warehouse(spark, rows)).collect()
    assert [(r.property_type, r.stays) for r in got] == [("A", 20)]


def test_q3_and_q4_hosts(spark):
    rows = [
        {"host_id": 1, "property_type": "A"}, {"host_id": 1, "property_type": "B",
                                               "listing_neighbourhood": "Surry Hills"},
        {"host_id": 2, "property_type": "A", "price": 1000},
    ]
    wh = warehouse(spark, rows)
    assert rows_of(questions.hosts_multi(wh)) == [(1,)]
    assert rows_of(questions.hosts_single(wh)) == [(2,)]
    q3 = questions.q3_local_rate(wh).collect()
    assert [(r.host_lga, r.total_listings, r.local_listings, r.local_rate) for r in q3] == [
        ("waverley", 2, 1, 50.0)]
    # host 2 earns 20 * 1000 = 20000 > 12 * 100
    assert questions.q4_mortgage_cover(wh).collect()[0].covered == 1.0


def test_q4_empty_input_gives_null(spark):
    wh = warehouse(spark, [{"host_name": ""}])
    assert questions.q4_mortgage_cover(wh).collect()[0].covered is None


def test_zero_census_population_gives_null_rate(spark):
    wh = warehouse(spark, [{}])
    rates = {r.lga_code: r.rate_20_34 for r in questions.age_bands(wh.fact_one()).collect()}
    assert rates == {10001: 40.0, 10002: None}


def test_fused_rows_equal_joined_slices(spark):
    wh = Warehouse.from_testdata(spark, SMOKE_DIR)
    joined = assemble({"l": wh.dim_listing().drop("updated_at", "valid_from", "valid_to"),
                       "h": wh.dim_host().drop("scd_id", "updated_at", "valid_from", "valid_to"),
                       "p": wh.dim_property().drop("updated_at", "valid_from", "valid_to")})
    fused = wh.rows(host=True, listing=True, property=True)
    cols = sorted(fused.columns)
    assert sorted(joined.columns) == cols
    assert joined.select(*cols).exceptAll(fused.select(*cols)).count() == 0
    assert fused.select(*cols).exceptAll(joined.select(*cols)).count() == 0
