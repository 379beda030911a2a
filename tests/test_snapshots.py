"""Persisted snapshot runs: equal to one bulk history, published whole, old versions kept."""

import os
import random

import pytest
from pyspark.sql import functions as F

from staylake.functions.dates import SCRAPED_DATE_FORMAT
from staylake.operators.history import scd2_bulk
from staylake.plans.warehouse import Warehouse
from staylake.session import scratch_path
from staylake.sources.snapshots import Slice, SnapshotStore, by_date, natural_slices, row_slices, run_snapshots
from tests.helpers import house, rows_of

DDL = "id bigint, host_id bigint, scraped_date string, host_name string"
HOST = Slice(("id", "host_id", "scraped_date", "host_name"), "host_id", "scraped_date", by_date(SCRAPED_DATE_FORMAT))


def _months(seed=3):
    rnd, rows = random.Random(seed), []
    for month in range(1, 5):
        of_month = [(len(rows) + i, rnd.choice([None, *range(40)]), f"2021-{month:02d}-{rnd.randrange(1, 28):02d}", rnd.choice("abc")) for i in range(60)]
        rows += of_month
        yield of_month


def _store(spark, buckets=4, **slices):
    return SnapshotStore(spark, scratch_path(spark, "snapshot-test"), slices or {"host": HOST}, buckets)


def test_runs_equal_one_bulk_history(spark):
    store, seen = _store(spark), []
    for of_month in _months():
        store.run(spark.createDataFrame(of_month, DDL))
        seen += of_month
        whole = scd2_bulk(spark.createDataFrame(seen, DDL), "host_id", "scraped_date", HOST.order_by)
        assert rows_of(store.read("host"), *whole.columns) == rows_of(whole)
    assert store.read("host").filter("valid_to IS NOT NULL").count() > 50
    # earlier runs stay readable
    first = scd2_bulk(spark.createDataFrame(seen[:60], DDL), "host_id", "scraped_date", HOST.order_by)
    assert rows_of(store.read("host", as_of=0)) == rows_of(first.select(*store.read("host").columns))


def test_only_folders_with_incoming_keys_are_written(spark):
    store = _store(spark, buckets=16)
    store.run(spark.createDataFrame([(i, i, "2021-01-01", "a") for i in range(200)], DDL))
    store.run(spark.createDataFrame([(900, 7, "2021-02-01", "b")], DDL))
    assert len([d for d in os.listdir(f"{store.path}/host/run=1/part=open") if d.startswith("bucket=")]) == 1
    held = store.last().slices["host"].open
    assert sorted(held.values()) == [0] * 15 + [1]
    assert store.read("host").count() == 201 and store.read("host").filter("valid_to = '2021-02-01'").count() == 1


def test_a_run_that_dies_changes_nothing(spark, monkeypatch):
    listing = Slice(("id", "host_id", "scraped_date"), "id", "scraped_date", HOST.order_by)
    store = _store(spark, host=HOST, listing=listing)
    store.run(spark.createDataFrame([(1, 1, "2021-01-01", "a"), (2, 2, "2021-01-01", "b")], DDL))
    before = {n: rows_of(store.read(n)) for n in store.slices}
    later = spark.createDataFrame([(3, 1, "2021-02-01", "c"), (4, 9, "2021-02-01", "d")], DDL)
    create = type(spark).createDataFrame
    with monkeypatch.context() as m:  # dies after the files, before the commit
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.run(later)
    assert type(spark).createDataFrame is create and os.path.exists(f"{store.path}/host/run=1")
    assert {n: rows_of(store.read(n)) for n in store.slices} == before
    assert store.run(later.filter("host_id = 1")) == 1  # the number is taken again, the dead run's files are gone
    assert [(r[1], r[3], r[-1]) for r in rows_of(store.read("host"), *HOST.columns, "valid_to")] == [(1, "a", "2021-02-01"), (2, "b", None), (1, "c", None)]


def test_empty_loads_and_expiry(spark):
    store = _store(spark)
    assert store.read("host") is None and store.expire() == []
    empty = spark.createDataFrame([], DDL)
    store.run(empty)
    assert store.read("host") is None
    for day in ("01", "02", "03"):
        store.run(spark.createDataFrame([(int(day), 1, f"2021-01-{day}", "a"), (int(day) + 10, 2, f"2021-01-{day}", "a")], DDL))
    store.run(empty)
    held = rows_of(store.read("host"))
    assert len(store.expire(keep=1)) == 2 and rows_of(store.read("host")) == held and len(held) == 6
    store.run(spark.createDataFrame([(99, 1, "2021-01-09", "z")], DDL))
    assert store.read("host").count() == 7


def test_models_read_the_persisted_slices(spark):
    rows = [{"scraped_date": f"2021-0{1 + i % 3}-15", "host_id": i % 4, "price": i} for i in range(12)]
    raw = house(spark, rows)
    store = SnapshotStore(spark, scratch_path(spark, "snapshot-test"), row_slices(), 4)
    run_snapshots(store, [raw.filter(F.col("scraped_date").startswith(f"2021-0{m}")) for m in (1, 2, 3)])
    plain, kept = Warehouse({"house": raw}), Warehouse({"house": raw}, history=store)
    for model in ("stg_host", "stg_listing", "stg_property", "fact_review"):
        expected = getattr(plain, model)()
        assert rows_of(getattr(kept, model)(), *expected.columns) == rows_of(expected)


def test_natural_slices_name_columns_once(spark):
    for s in natural_slices().values():
        assert len(set(s.columns)) == len(s.columns) and {s.key, s.updated_at, s.tie_break} <= set(s.columns)
