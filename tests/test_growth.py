"""What queries move, write and hold in a task must grow with their input, not with fixed numbers of partitions or files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from staylake.functions.dates import SCRAPED_DATE_FORMAT
from staylake.operators import history
from staylake.plans import incremental, registry
from staylake.session import input_bytes, input_width, scratch_path, widen_shuffles
from staylake.sources import fixtures
from staylake.sources.sinks import write_table
from staylake.sources.snapshots import Slice, SnapshotStore, by_date
from tests.conftest import SMOKE_DIR
from tests.helpers import house, rows_of

WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def width(spark):
    before = spark.conf.get(WIDTH, None)
    yield
    spark.conf.unset(WIDTH) if before is None else spark.conf.set(WIDTH, before)


def test_shuffles_are_as_wide_as_the_input_asks(spark, width):
    path = scratch_path(spark, "growth")
    spark.range(50_000).repartition(3).write.parquet(path)
    held = sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet"))
    assert input_bytes(spark, path) == held
    assert input_width(spark, path) == 1 and input_width(spark, path, unit=held // 4) in (4, 5)
    widen_shuffles(spark, 1)
    assert spark.conf.get(WIDTH, None) is None
    widen_shuffles(spark, 37)
    grouped = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    grouped.collect()
    assert "hashpartitioning(k" in grouped._jdf.queryExecution().executedPlan().toString()
    assert ", 37)" in grouped._jdf.queryExecution().executedPlan().toString()


def test_lines_meet_customers_after_they_are_numbered(spark):
    """Line items are moved by order and by part only; numbers count lines whose customer is missing or repeated."""
    base = scratch_path(spark, "growth")
    tables = {
        "lineitem": [(1, 1, p, 1, 5.0, 10.0 + p, 0.0, 0.0, "N", "O", "1995-03-01") for p in (1, 2)] + [(2, 1, 1, 1, 5.0, 9.0, 0.0, 0.0, "N", "F", "1995-03-02")],
        "orders": [(1, 7, "1-URGENT"), (1, 8, "5-LOW"), (1, None, "5-LOW"), (2, 9, "5-LOW")],
        "customer": [(7, "a", 0, 1.0), (7, "b", 1, 9000.0), (None, "c", 0, 1.0), (8, "d", 0, 1.0)],
        "part": [(1, "X", 3), (2, "Y", 4)], "supplier": [(1, 1)], "nation": [(0, "N0", 0), (1, "N1", 0)]}
    ddl = {
        "lineitem": "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
                    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string", "customer": "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double",
        "part": "p_partkey bigint, p_type string, p_size int", "supplier": "s_suppkey bigint, s_nationkey bigint", "nation": "n_nationkey bigint, n_name string, n_regionkey bigint"}
    for name, rows in tables.items():
        df = spark.createDataFrame(rows, ddl[name])
        df = df.withColumn("l_shipdate", F.to_timestamp("l_shipdate")) if name == "lineitem" else df
        df.write.parquet(f"{base}/{name}.parquet")
    feed = fixtures.house_feed(spark, base)
    first = (1 * fixtures.LINE_SLOTS + 1) * fixtures.COPY_SLOTS
    got = rows_of(feed.select("host_name", "listing_id", "id"))
    # three orders share the key: lines 1..3 are of part 1 and 4..6 of part 2, whichever order they met
    assert sorted((r[0], r[1]) for r in got) == [(n, p) for n in "abd" for p in (1, 2)]
    assert {r[2] - first for r in got if r[1] == 1} <= {1, 2, 3} and {r[2] - first for r in got if r[1] == 2} <= {4, 5, 6}
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = fixtures.house_feed(spark, base)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert not [l for l in lines if "hashpartitioning(l_suppkey" in l]
    window = plan.index("Window [")
    assert "hashpartitioning(o_custkey" not in plan[:window]  # customers meet orders, below the numbering


DDL = "id bigint, host_id bigint, scraped_date string, host_name string"
HOST = Slice(("id", "host_id", "scraped_date", "host_name"), "host_id", "scraped_date", by_date(SCRAPED_DATE_FORMAT))
LOADS = [[(100 * m + i, [None, *range(6)][i % 7], f"2021-{m:02d}-{1 + i % 5:02d}", f"n{i}") for i in range(40)] for m in (1, 2, 3)]


def _versions(spark, hot_rows, monkeypatch):
    monkeypatch.setattr(history, "HOT_ROWS", hot_rows)
    first, second = (spark.createDataFrame(rows, DDL) for rows in LOADS[:2])
    before = history.scd2_bulk(first, "host_id", "scraped_date", HOST.order_by)
    return history.scd2_parts(before, second, "host_id", "scraped_date", HOST.order_by)[1]


def test_a_merge_moves_rows_once_unless_a_key_is_hot(spark, monkeypatch):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        cold, hot = _versions(spark, 1000, monkeypatch), _versions(spark, 3, monkeypatch)
        moves = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (cold, hot)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert moves[0] == moves[1] - 1 == 3  # two of the history that is merged into, one of the merge
    assert rows_of(cold) == rows_of(hot) and len(rows_of(cold)) > 7


def test_stored_versions_leave_out_what_follows_from_them(spark):
    store = SnapshotStore(spark, scratch_path(spark, "growth"), {"host": HOST}, 4)
    for rows in LOADS:
        store.run(spark.createDataFrame(rows, DDL))
    stored = spark.read.parquet(f"{store.path}/host/run=2/part=open")
    assert not {"scd_id", "updated_at", "valid_from"} & set(stored.columns) and "valid_to" in stored.columns
    whole = history.scd2_bulk(spark.createDataFrame([r for rows in LOADS for r in rows], DDL), "host_id", "scraped_date", HOST.order_by)
    assert store.read("host").columns == whole.columns and rows_of(store.read("host")) == rows_of(whole)


def test_feed_files_can_be_compressed(spark):
    path = scratch_path(spark, "growth")
    write_table(spark.range(1000).selectExpr("id AS ID"), path, fmt="csv", compression="gzip")
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    assert spark.read.option("header", True).csv(path).count() == 1000


def test_stored_slices_have_more_buckets_for_more_input(spark, monkeypatch):
    monkeypatch.setattr(registry, "BUCKET_BYTES", 8_000)
    monkeypatch.setattr(registry, "_SLICES", {})
    slices = registry._stored_slices(spark, SMOKE_DIR, ["listing"])
    expected = input_width(spark, *registry._feed_tables(SMOKE_DIR), unit=8_000)
    (database,) = registry._SLICES.values()
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {database}.listing").collect()}
    assert int(described["Num Buckets"]) == expected > registry.SLICE_BUCKETS and slices["listing"].count() > 0


def test_a_load_of_a_mart_computes_its_figures_once(spark, monkeypatch):
    calls, write = [], incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda *a: calls.append(a[2]) or write(*a))
    mart = incremental.KpiMart(spark, scratch_path(spark, "growth"), ["listing_neighbourhood"])
    rows = house(spark, [{"scraped_date": f"2021-0{1 + i % 3}-15", "host_id": i, "price": i} for i in range(6)])
    rows = rows.withColumn("scraped_date", F.to_date("scraped_date"))
    assert mart.load(rows) == ["01/2021", "02/2021", "03/2021"] and calls == ["mart-load"]
