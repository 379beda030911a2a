"""Partitioned catalog, stored slices, rejects, continued ids, one-scan questions."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from staylake.operators.hosts import host_room_spread, hosts_by_kinds
from staylake.operators.joins import assemble
from staylake.plans import questions
from staylake.plans.warehouse import Warehouse
from staylake.session import scratch_path
from staylake.sources import catalog, schemas
from staylake.sources.catalog import (create_raw_tables, read_raw_tables, read_slices, register_months, save_raw_tables,
                                      save_slices)
from staylake.sources.feeds import house_ids, load_checked, serial_ids, write_checked, with_rejects
from tests.conftest import SMOKE_DIR
from tests.helpers import HOUSE_DDL, house, rows_of


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_are_partitions(spark):
    database = f"raw_{uuid.uuid4().hex[:8]}"
    base = create_raw_tables(spark, database, scratch_path(spark, "catalog-test"))
    first = house(spark, [{"scraped_date": d, "price": 1} for d in ("2021-01-03", "2021-01-20", "2021-02-01", None)])
    save_raw_tables(spark, {"house": first}, database)
    again = house(spark, [{"scraped_date": "2021-02-09", "price": 7}, {"scraped_date": "2021-03-09", "price": 8}])
    save_raw_tables(spark, {"house": again}, database, files_per_month=2)
    got = read_raw_tables(spark, database)["house"]
    assert got.columns == [c.split()[0] for c in HOUSE_DDL.split(", ")]
    assert sorted((str(r.scraped_date), r.price) for r in got.collect()) == [
        ("2021-01-03", 1), ("2021-01-20", 1), ("2021-02-09", 7), ("2021-03-09", 8), ("None", 1)]
    one = read_raw_tables(spark, database, ["2021-02"])["house"]
    assert [r.price for r in one.collect()] == [7]
    assert "PartitionFilters: [isnotnull(scrape_month" in _plan(one) and "(scrape_month#" in _plan(one)
    # a month written from outside is seen once registered
    (house(spark, [{"scraped_date": "2021-05-01", "price": 9}]).write.parquet(f"{base}/house/scrape_month=2021-05"))
    register_months(spark, database)
    assert read_raw_tables(spark, database, ["2021-05"])["house"].count() == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("files, most", [(2, 1000), (1, 1000), (2, 3)])
def test_months_are_gathered_without_a_shuffle(spark, monkeypatch, files, most):
    """Each month by at most ``files`` tasks; more than ``MONTHS`` months are shuffled; missing dates are kept."""
    monkeypatch.setattr(catalog, "MONTHS", most)
    dates = ["2021-01-03", "2021-01-20", "2021-02-01", "2021-03-05", None, "", "odd/date=1"]
    rows = house(spark, [{"scraped_date": d, "price": n, "host_name": None if n % 5 == 0 else f"h{n}"} for d in dates for n in range(40)]).repartition(6)
    stored = catalog.stored_by_month(rows)
    gathered = catalog._gathered(stored, files)
    assert ("Exchange" in _plan(gathered)) == (most < len(dates) - 2)
    tasks = gathered.withColumn("task", F.spark_partition_id()).groupBy(catalog.MONTH).agg(F.countDistinct("task").alias("n")).collect()
    assert len(tasks) == 5 and all(r.n <= files for r in tasks)
    if most > len(dates):
        with catalog._set(spark, catalog.REPLACING):
            assert catalog._gathered(stored, files).rdd.getNumPartitions() >= 5  # months are written side by side
    database = f"raw_{uuid.uuid4().hex[:8]}"
    base = create_raw_tables(spark, database, scratch_path(spark, "catalog-test"))
    save_raw_tables(spark, {"house": rows.withColumn("price", F.lit(-1))}, database, files_per_month=files)
    for part in (stored.filter(F.col("scraped_date") >= "2021-02-01"), stored.filter(F.col("scraped_date").isNull() | (F.col("scraped_date") < "2021-02-01")),
                 stored.limit(0)):
        save_raw_tables(spark, {"house": part}, database, files_per_month=files, by_month=True)
    got = read_raw_tables(spark, database)["house"]
    assert rows_of(got, *got.columns) == rows_of(rows, *got.columns)
    folders = glob.glob(f"{base}/house/*/")
    assert len(folders) == 5 and all(len(glob.glob(f"{f}*.parquet")) <= files for f in folders)
    assert all(spark.conf.get(key).lower() != value for key, value in catalog.REPLACING.items())


def test_stored_slices_join_without_a_shuffle(spark):
    wh = Warehouse.from_testdata(spark, SMOKE_DIR, materialized=True)
    database, drop = f"slices_{uuid.uuid4().hex[:8]}", ("scd_id", "updated_at", "valid_from", "valid_to")
    parts = {"listing": wh.dim_listing(), "host": wh.dim_host(), "property": wh.dim_property(), "review": wh.fact_review()}
    save_slices(spark, {n: d.drop(*drop) for n, d in parts.items()}, database, 4)
    joined = assemble(read_slices(spark, list(parts), database))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(assemble(read_slices(spark, list(parts), database)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3 and "Bucketed: true" in plan
    fused = wh.rows(host=True, listing=True, property=True, review=True)
    assert rows_of(joined, *fused.columns) == rows_of(fused)
    # with repeated and missing ids the stored form is the join, as the models define it
    own = f"slices_{uuid.uuid4().hex[:8]}"
    a = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id bigint, x string")
    b = spark.createDataFrame([(1, 7), (2, 8), (None, 9)], "id bigint, y int")
    save_slices(spark, {"a": a, "b": b}, own, 2)
    assert rows_of(assemble(read_slices(spark, ["a", "b"], own))) == [(1, "a", 7), (1, "b", 7)]


def test_rejected_values_are_kept_and_counted(spark):
    text = house(spark, [{}] * 6).withColumns({c: F.col(c).cast("string") for c in schemas.HOUSE_TYPES if c in HOUSE_DDL})
    spoilt = text.withColumns({
        "price": F.element_at(F.array(*[F.lit(x) for x in ("12", "12.5", "x", "", "99999999999", None)]), F.col("id").cast("int")),
        "has_availability": F.when(F.col("id") == 2, "perhaps").otherwise(F.col("has_availability")),
        "listing_id": F.when(F.col("id") == 1, "9007199254740993123").otherwise(F.col("listing_id"))})
    path = scratch_path(spark, "checked-test")
    loaded = load_checked(spoilt, "house", path)
    assert [(r.id, r.column, r.text) for r in loaded.rejects.orderBy("id", "column").collect()] == [
        (2, "has_availability", "perhaps"), (3, "price", "x"), (4, "price", ""), (5, "price", "99999999999")]
    assert {k: v for k, v in loaded.counts.items() if v} == {"rows_written": 6, "price": 3, "has_availability": 1}
    table = {r.id: r for r in loaded.table.collect()}
    assert [table[i].price for i in range(1, 7)] == [12, 13, None, None, None, None]
    assert table[1].listing_id == 9007199254740993123 and "_rejects" not in loaded.table.columns
    empty = load_checked(spoilt.limit(0), "house", scratch_path(spark, "checked-test"))
    assert empty.rejects.count() == 0 and set(empty.counts.values()) == {0}
    own = load_checked(spoilt.drop("id"), "house", scratch_path(spark, "checked-test"), ids=house_ids)
    assert own.rejects.select("column").distinct().count() == 2 and own.table.select("id").distinct().count() == 6


def test_shared_ids_stop_a_load(spark):
    rows = with_rejects(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id bigint, x string"), {"x": "string"})
    with pytest.raises(ValueError, match=r"\(1, 2\)"):
        write_checked(rows, scratch_path(spark, "checked-test"), {"x": "string"})
    assert write_checked(rows, scratch_path(spark, "checked-test"), {"x": "string"}, unique=False).table.count() == 3


def test_ids_go_on_from_load_to_load(spark):
    first = serial_ids(spark.range(100).selectExpr("id AS x").repartition(7), order=["x"])
    assert [(r.x, r.id) for r in first.orderBy("x").collect()] == [(i, i + 1) for i in range(100)]
    second = serial_ids(spark.range(50).selectExpr("id AS x").repartition(5), stored=first)
    ids = sorted(r.id for r in second.collect())
    assert ids == list(range(101, 151)) and ids == sorted(r.id for r in second.collect())  # a re-read gives the same
    assert serial_ids(spark.range(0).selectExpr("id AS x"), stored=first).count() == 0
    assert [r.id for r in serial_ids(spark.range(1).selectExpr("id AS x"), stored=spark.range(0)).collect()] == [1]


def test_hosts_by_kinds_equals_the_spread(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "a", None), (2, "a", 1), (3, None, None), (None, "a", 1), (None, "b", 1), (4, "a", 1), (4, "b", 1)]
    sums = spark.createDataFrame(rows, "host bigint, t string, n int")
    spread = {r.host: r.multi for r in host_room_spread(sums, "host", ["t", "n"]).collect()}
    kinds = sums.withColumn("kind", F.struct("t", "n"))
    for multi in (True, False):
        assert {r.host for r in hosts_by_kinds(kinds, "host", "kind", multi).collect()} == {h for h, m in spread.items() if m == multi}
    none = kinds.withColumn("kind", F.when(F.col("host") != 4, F.col("kind")))
    assert 4 not in {r.host for m in (True, False) for r in hosts_by_kinds(none, "host", "kind", m).collect()}


@pytest.mark.parametrize("name", ["q2_best_type", "q3_local_rate", "q4_mortgage_cover"])
def test_questions_scan_the_listings_once(spark, name):
    wh = Warehouse.from_testdata(spark, SMOKE_DIR, materialized=True)
    plan = getattr(questions, name)(wh)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scrape_id#") == 1  # the listings relation, once
    if name == "q2_best_type":
        assert "Window" not in plan


def test_sorted_outputs_are_in_order(spark):
    from staylake.plans import marts

    wh = Warehouse.from_testdata(spark, SMOKE_DIR, materialized=True)
    key = lambda x: [(v is not None, v) for v in x]  # noqa: E731 - ascending, NULL first, as Spark sorts
    for df, cols in ((marts.dm_listing_neighbourhood(wh, sort=True), ["listing_neighbourhood", "month_year"]),
                     (marts.dm_property_type(wh, sort=True), [*marts.PROPERTY_KEYS, "month_year"]),
                     (marts.dm_host_neighbourhood(wh, sort=True), ["host_neighbourhood_lga", "month_year"])):
        got = [tuple(r[c] for c in cols) for r in df.collect()]
        assert got == sorted(got, key=key) and len(got) > 10
    best = [(-r.stays, r.listing_neighbourhood) for r in questions.q2_best_type(wh, sort=True).collect()]
    rates = [(-r.local_rate, r.host_lga) for r in questions.q3_local_rate(wh, sort=True).collect()]
    assert best == sorted(best) and rates == sorted(rates) and len(best) == 5
