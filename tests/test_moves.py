"""Large feeds: files as many as tasks, rows of a history moved once, slices of the same versions kept once."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from staylake.functions.dates import SCRAPED_DATE_FORMAT
from staylake.operators import history
from staylake.plans import registry
from staylake.session import scratch_path
from staylake.sources import catalog, fixtures, schemas, sinks, snapshots
from staylake.sources.snapshots import Slice, SnapshotStore, by_date
from staylake.streaming import ingest_feed, latest_history
from tests.conftest import SMOKE_DIR
from tests.helpers import house, rows_of

DDL = "id bigint, host_id bigint, scraped_date string, host_name string, price int"
ORDER = by_date(SCRAPED_DATE_FORMAT)
HOST = Slice(("id", "host_id", "scraped_date", "host_name"), "host_id", "scraped_date", ORDER)
PRICE = Slice(("id", "host_id", "scraped_date", "price"), "host_id", "scraped_date", ORDER)
LOADS = [[(100 * m + i, [None, *range(6)][i % 7], f"2021-{m:02d}-{1 + i % 5:02d}", f"n{i}", i) for i in range(40)] for m in (1, 2, 3)]


def _folder(path):
    return path.removeprefix("file://")


@pytest.fixture
def wide(spark):
    """Joins that move both sides, and no small partitions joined: as with a large input."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_feed_files_are_as_many_as_tasks(spark, wide, monkeypatch):
    """Years are written in one pass by every task, the same number of files in each, a listing in one of them."""
    monkeypatch.setattr(registry, "FEED_FILE_BYTES", 1000)
    monkeypatch.setattr(registry, "_FEEDS", {})
    plan = fixtures.house_feed(spark, SMOKE_DIR, by_listing=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_partkey") == 1  # the move that brings lines to their parts
    pattern, of_year = registry._yearly_feed(spark, SMOKE_DIR)
    assert of_year == 8 and registry._yearly_feed(spark, SMOKE_DIR) == (pattern, of_year)
    years = sorted(os.path.dirname(p) for p in {os.path.dirname(f) + "/" for f in glob.glob(_folder(pattern))})
    assert len(years) == 7 and {len(glob.glob(f"{y}/*.csv.gz")) for y in years} == {of_year}
    times = [{os.path.getmtime(f) for f in glob.glob(f"{y}/*.csv.gz")} for y in years]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
    read = spark.read.option("header", True).csv(pattern)
    held = read.select("LISTING_ID", F.substring("SCRAPED_DATE", 1, 4).alias("y"), F.input_file_name().alias("f")).distinct()
    assert held.groupBy("LISTING_ID", "y").count().filter("count > 1").isEmpty()
    feed = fixtures.house_feed(spark, SMOKE_DIR)
    expected = feed.select(*[F.col(c).cast("string") for c in feed.columns])
    assert rows_of(read, *[c.upper() for c in feed.columns]) == rows_of(expected)


def test_files_arranged_by_folder_come_in_its_order(spark):
    """Folders with fewer files get header-only ones; the stream takes the years in order, those without a date first."""
    path = scratch_path(spark, "moves")
    columns = [f.name for f in schemas.HOUSE_FEED.fields]
    rows = house(spark, [{"listing_id": i % 5, "scraped_date": f"{y}-03-{1 + i:02d}" if y else None}
                         for y, n in ((2022, 1), (2021, 12), (None, 2)) for i in range(n)])
    feed = rows.select(*[F.col(c).alias(c.upper()) for c in ["id", *columns]], F.substring("scraped_date", 1, 4).alias("feed_year"))
    sinks.write_table(feed.repartition(3, "LISTING_ID"), path, partition_by=["feed_year"], fmt="csv", compression="gzip")
    most = sinks.arrange_files(spark, path, feed.columns[:-1])
    folders = [f"{_folder(path)}/feed_year={y}" for y in ("__HIVE_DEFAULT_PARTITION__", "2021", "2022")]
    files = [sorted(glob.glob(f"{d}/*.csv.gz")) for d in folders]
    assert [len(f) for f in files] == [most] * 3 and most > 1
    assert max(map(os.path.getmtime, files[0])) < min(map(os.path.getmtime, files[1])) and max(map(os.path.getmtime, files[1])) < min(map(os.path.getmtime, files[2]))
    assert sum(len(gzip.open(f, "rt").read().splitlines()) == 1 for f in files[2]) == most - 1
    base = scratch_path(spark, "moves")
    ingest_feed(spark, f"{path}/*/*.csv.gz", f"{base}/raw", f"{base}/history", f"{base}/checkpoint", files_per_batch=most)
    assert spark.read.parquet(f"{base}/raw").count() == 15
    assert spark.read.parquet(f"{base}/history/commits").count() == 3
    got = latest_history(spark, f"{base}/history")
    whole = history.scd2_bulk(rows.select("id", "listing_id", "scraped_date", "listing_neighbourhood"), "listing_id", "scraped_date", ORDER)
    assert rows_of(got, *whole.columns) == rows_of(whole)
    stored = spark.read.parquet(f"{base}/history/versions/batch=1")
    assert not {"scd_id", "valid_from"} & set(stored.columns)


def test_a_stream_goes_on_from_a_history_with_all_columns(spark):
    """Batches of before wrote id and start of versions, and a commit without their key."""
    base = scratch_path(spark, "moves")
    columns = ["id", "listing_id", "scraped_date", "listing_neighbourhood"]
    old = house(spark, [{"listing_id": i % 3, "scraped_date": f"2021-01-0{1 + i}"} for i in range(6)])
    kept = history.scd2_bulk(old.select(*columns), "listing_id", "scraped_date", ORDER)
    part = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
    kept.withColumn("part", part).write.partitionBy("part").parquet(f"{base}/history/versions/batch=-1")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema)
    spark.createDataFrame([(-1, ddl, True)], "batch bigint, columns string, together boolean").write.parquet(f"{base}/history/commits/run=-1")
    assert rows_of(latest_history(spark, f"{base}/history"), *kept.columns) == rows_of(kept)
    new = house(spark, [{"id": 100 + i, "listing_id": i, "scraped_date": "2021-02-01"} for i in range(4)])
    feed = new.select(*[F.col(c).alias(c.upper()) for c in ["id", *[f.name for f in schemas.HOUSE_FEED.fields]]])
    feed.write.option("header", True).csv(f"{base}/feed")
    ingest_feed(spark, f"{base}/feed/*.csv", f"{base}/raw", f"{base}/history", f"{base}/checkpoint", files_per_batch=100)
    whole = history.scd2_bulk(old.unionByName(new).select(*columns), "listing_id", "scraped_date", ORDER)
    assert rows_of(latest_history(spark, f"{base}/history"), *whole.columns) == rows_of(whole)


def _check(store, rows):
    for name, s in store.slices.items():
        whole = history.scd2_bulk(rows.select(*s.columns), s.key, s.updated_at, s.order_by)
        assert store.read(name).columns == whole.columns and rows_of(store.read(name)) == rows_of(whole)


def test_slices_of_the_same_versions_are_merged_once(spark, monkeypatch):
    calls, line = [], snapshots.scd2_line
    monkeypatch.setattr(snapshots, "scd2_line", lambda *a: calls.append(a) or line(*a))
    by_id = Slice(("id", "scraped_date", "price"), "id", "scraped_date", ORDER)
    store = SnapshotStore(spark, scratch_path(spark, "moves"), {"host": HOST, "price": PRICE, "row": by_id}, 4)
    for rows in LOADS:
        store.run(spark.createDataFrame(rows, DDL))
    assert len(calls) == 2 * 3
    assert sorted(d for d in os.listdir(_folder(store.path)) if not d.startswith(".")) == ["commits", "host", "row"]
    _check(store, spark.createDataFrame([r for rows in LOADS for r in rows], DDL))
    assert rows_of(store.read("price", as_of=0)) == rows_of(history.scd2_bulk(spark.createDataFrame(LOADS[0], DDL).select(*PRICE.columns), "host_id", "scraped_date", ORDER))
    assert len(store.expire(keep=1)) == 2 * 2  # open folders of the first two runs
    _check(store, spark.createDataFrame([r for rows in LOADS for r in rows], DDL))


def test_slices_stay_where_an_earlier_store_holds_them(spark, monkeypatch):
    """Commits of before name no folder: each slice has its own, and goes on there; a new slice gets a folder of its own."""
    path = scratch_path(spark, "moves")
    before = "run bigint, slices map<string, struct<columns: string, open: map<int, bigint>>>, source string"
    first = spark.createDataFrame(LOADS[0], DDL)
    entries = {}
    for name, s in (("host", HOST), ("price", PRICE)):
        kept = history.scd2_bulk(first.select(*s.columns), s.key, s.updated_at, s.order_by)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)  # with id and start of versions
        bucket = F.pmod(F.xxhash64("host_id"), F.lit(4)).cast("int")
        parts = kept.withColumns({"part": F.when(F.col("valid_to").isNull(), "open").otherwise("closed"), "bucket": bucket})
        parts.write.partitionBy("part", "bucket").parquet(f"{path}/{name}/run=0")
        entries[name] = (ddl, {r[0]: 0 for r in parts.select("bucket").distinct().collect()})
    spark.createDataFrame([(0, entries, None)], before).write.parquet(f"{path}/commits/run=0")
    store = SnapshotStore(spark, path, {"host": HOST, "price": PRICE}, 4)
    _check(store, first)
    for rows in LOADS[1:]:
        store.run(spark.createDataFrame(rows, DDL))
    _check(store, spark.createDataFrame([r for rows in LOADS for r in rows], DDL))
    assert {h.folder for h in store.last().slices.values()} == {"host", "price"}


def _moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_history_moves_its_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([r for rows in LOADS for r in rows] * 2, DDL)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        whole = history.scd2_bulk(df, "host_id", "scraped_date", ORDER)
        once = history.scd2_history(df, "host_id", "scraped_date", ORDER)
        monkeypatch.setattr(history, "HOT_ROWS", 3)
        hot = history.scd2_history(df, "host_id", "scraped_date", ORDER)
        assert [_moves(x) for x in (whole, once, hot)] == [2, 1, 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert once.columns == hot.columns == whole.columns
    assert rows_of(once) == rows_of(hot) == rows_of(whole) and len(rows_of(whole)) > 20


def test_versioned_queries_move_rows_once(spark, monkeypatch):
    calls, line = [], history.scd2_line
    monkeypatch.setattr(history, "scd2_line", lambda *a: calls.append(a[2]) or line(*a))
    registry.QUERIES["scd2_review"](spark, SMOKE_DIR)
    assert calls == ["listing_id"]


def test_hot_keys_are_found_among_groups(spark, monkeypatch):
    df = spark.range(100).selectExpr("IF(id < 30, NULL, id % 40) AS k")
    for groups in (1, 4, 65_536):
        monkeypatch.setattr(history, "KEY_GROUPS", groups)
        for most, hot in ((29, True), (30, False)):
            monkeypatch.setattr(history, "HOT_ROWS", most)
            assert history._has_hot_key(df, ["k"]) is hot


def test_a_merge_by_time_with_gaps_equals_the_one_that_moves_all_columns(spark):
    """Missing and equal times, times before the open version, dates spelled differently."""
    days = [None, "", "2021-1-2", "2021-01-02", "2021-01-05", "2021-02-01"]
    rows = [(i, [None, 1, 2, 3][i % 4], days[(i * 7 + i // 5) % (4 if i < 24 else 6)], f"n{i}", i) for i in range(48)]
    first, second = spark.createDataFrame(rows[:24], DDL), spark.createDataFrame(rows[24:], DDL)
    kept = history.scd2_bulk(first, "host_id", "scraped_date", ORDER)
    closed, old = history.scd2_parts(kept, second, "host_id", "scraped_date", ORDER)
    line = history.scd2_line(history.current_rows(kept), second, "host_id", "scraped_date", ORDER)
    assert rows_of(line) == rows_of(old, *line.columns) and len(rows_of(line)) > 4


def test_the_sink_moves_no_rows_by_month(spark, monkeypatch):
    for module in (catalog, sinks):
        monkeypatch.setattr(module, "dealt_by", lambda *a: (_ for _ in ()).throw(AssertionError("rows are shuffled by month")))
    got = registry.QUERIES["sink_roundtrip"](spark, SMOKE_DIR)
    expected = fixtures.house(spark, SMOKE_DIR)
    assert rows_of(got) == rows_of(expected, *got.columns)
    months = {}
    for f in got.inputFiles():
        months.setdefault(os.path.dirname(f), []).append(f)
    assert len(months) > 50 and max(map(len, months.values())) <= registry.FILES_PER_MONTH


def test_writing_months_again_replaces_them_only(spark):
    rows = house(spark, [{"scraped_date": f"2021-0{1 + i % 3}-15" if i % 5 else None, "price": i} for i in range(30)])
    path = scratch_path(spark, "moves")
    stored = catalog.stored_by_month(rows, sort=True)
    catalog.write_months(stored, path, 2)
    catalog.write_months(stored.filter("scraped_date >= '2021-03-01'").withColumn("price", F.lit(-1)), path, 2)
    expected = rows.withColumn("price", F.when(F.col("scraped_date") >= "2021-03-01", -1).otherwise(F.col("price")))
    assert rows_of(spark.read.parquet(path), *rows.columns) == rows_of(expected)
