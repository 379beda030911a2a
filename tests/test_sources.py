import pytest

from staylake.session import scratch_path
from staylake.sources import schemas
from staylake.sources.feeds import coerce_types, coercion_rejects, fill_defaults, load_feed, union_months
from staylake.sources.sinks import write_table
from tests.helpers import rows_of


def test_coerce_rounds_half_away_and_rejects(spark):
    df = spark.createDataFrame([("LGA1", 2.5, "3"), ("LGA2", 2.4, "x"), ("LGA3", -2.5, None)],
                               "lga_code_2016 string, a double, b string")
    out = coerce_types(df, {"a": "int", "b": "int"})
    assert rows_of(out, "lga_code_2016", "a", "b") == [("LGA1", 3, 3), ("LGA2", 2, None), ("LGA3", -3, None)]
    rej = coercion_rejects(df, {"a": "int", "b": "int"}).first()
    assert (rej.a, rej.b) == (0, 1)


def test_boolean_text_and_fill(spark):
    df = spark.createDataFrame([("t", None), ("false", "x"), (None, None)], "host_is_superhost string, host_name string")
    out = fill_defaults(coerce_types(df, {"host_is_superhost": "boolean"}), schemas.HOUSE_FILL)
    assert [tuple(r) for r in out.collect()] == [(True, ""), (False, "x"), (False, "")]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, 5)], "id long, review_scores_rating int")
    b = spark.createDataFrame([(2,)], "id long")
    out = fill_defaults(union_months([a, b]), schemas.HOUSE_FILL)
    assert rows_of(out) == [(1, 5), (2, 0)]


def test_write_table_guard_and_dynamic_overwrite(spark):
    path = scratch_path(spark, "sink-test")
    df = spark.createDataFrame([(1, "2020-01"), (2, "2020-02")], "v long, m string")
    write_table(df, path, partition_by=["m"])
    write_table(spark.createDataFrame([(3, "2020-02")], "v long, m string"), path, partition_by=["m"])
    assert rows_of(spark.read.parquet(path), "v", "m") == [(1, "2020-01"), (3, "2020-02")]
    flat = scratch_path(spark, "sink-test-flat")
    assert write_table(df, flat)
    assert not write_table(df.limit(0), flat)  # an empty load does not wipe the table
    assert spark.read.parquet(flat).count() == 2


def test_feed_header_is_checked(spark):
    path = scratch_path(spark, "feed-test")
    good = spark.createDataFrame([(10001, "Sydney")], "LGA_CODE int, LGA_NAME string")
    write_table(good, path, fmt="csv")
    assert [tuple(r) for r in load_feed(spark, "nsw_lga_code", path).collect()] == [(10001, "Sydney")]
    bad_path = scratch_path(spark, "feed-test-bad")
    bad = spark.createDataFrame([("Sydney", 10001)], "LGA_NAME string, LGA_CODE int")
    write_table(bad, bad_path, fmt="csv")
    with pytest.raises(Exception):
        load_feed(spark, "nsw_lga_code", bad_path).collect()


def test_catalog_tables_and_views(spark):
    import uuid

    from staylake.plans.warehouse import Warehouse
    from staylake.sources import fixtures
    from staylake.sources.catalog import create_raw_tables, save_raw_tables
    from tests.conftest import SMOKE_DIR

    db = f"raw_{uuid.uuid4().hex[:8]}"
    create_raw_tables(spark, db, scratch_path(spark, "catalog-test"))
    create_raw_tables(spark, db)  # idempotent
    save_raw_tables(spark, fixtures.raw_tables(spark, SMOKE_DIR), db)
    assert spark.table(f"{db}.house").count() == fixtures.house(spark, SMOKE_DIR).count()
    wh = Warehouse.from_catalog(spark, db)
    names = wh.register_views()
    assert "fact_listing" in names
    direct = Warehouse.from_testdata(spark, SMOKE_DIR).dim_host().count()
    assert spark.sql("SELECT COUNT(*) FROM dim_host").first()[0] == direct


def test_feed_folder_to_models(spark):
    """Feeds laid out as files (LGA and census CSVs, monthly listing files)
    load into raw tables, and every model builds from them."""
    from pyspark.sql import functions as F

    from staylake.plans.build import MODELS, build_models
    from staylake.plans.warehouse import Warehouse
    from staylake.sources import fixtures
    from staylake.sources.feeds import FEED_FILES, LISTINGS_FOLDER, load_feeds
    from tests.conftest import SMOKE_DIR

    folder = scratch_path(spark, "feed-folder")
    feeds = {"nsw_lga_code": fixtures.lga_code(spark, SMOKE_DIR), "nsw_lga_suburb": fixtures.lga_suburb(spark, SMOKE_DIR),
             "census_two": fixtures.census_two_feed(spark, SMOKE_DIR), "census_one": fixtures.census_one_feed(spark, SMOKE_DIR)}
    for name, df in feeds.items():
        df = df.drop("id")
        write_table(df.select(*[F.col(c).alias(c.upper()) for c in df.columns]), f"{folder}/{FEED_FILES[name]}", fmt="csv")
    house = fixtures.house_feed(spark, SMOKE_DIR).drop("id")
    months = ["01_1997", "02_1997", "03_1997"]
    for m in months:
        mm, yyyy = m.split("_")
        part = house.filter(F.col("scraped_date").startswith(f"{yyyy}-{mm}"))
        write_table(part.select(*[F.col(c).alias(c.upper()) for c in part.columns]),
                    f"{folder}/{LISTINGS_FOLDER}/{m}.csv", fmt="csv")
    raw = load_feeds(spark, folder, months)
    expected = house.filter(F.substring("scraped_date", 1, 7).isin("1997-01", "1997-02", "1997-03")).count()
    assert raw["house"].count() == expected
    assert raw["house"].select("id").distinct().count() == expected
    assert raw["census_two"].count() == 5 and raw["nsw_lga_suburb"].count() == 26
    out = build_models(Warehouse(raw), scratch_path(spark, "models"))
    assert set(out) == set(MODELS)
    assert spark.read.parquet(out["dm_listing_neighbourhood"]).count() > 0
    assert spark.read.parquet(out["q1_best_worst"]).count() == 2


def test_files_per_partition_bounds_file_count(spark):
    import os as _os

    path = scratch_path(spark, "sink-files")
    df = spark.range(0, 20000, numPartitions=16).selectExpr("id", "cast(id % 5 as int) AS m")
    write_table(df, path, partition_by=["m"], files_per_partition=3)
    for m in range(5):
        files = [f for f in _os.listdir(f"{path}/m={m}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 3
    assert spark.read.parquet(path).count() == 20000
