import os

import pytest
from pyspark.sql import functions as F

from staylake.operators.history import current_rows, scd2_bulk
from staylake.session import scratch_path
from staylake.sources import fixtures, schemas
from staylake.sources.feeds import coerce_types, fill_defaults
from staylake.sources.snapshots import SnapshotStore, natural_slices
from staylake.streaming import ingest_feed, ingest_slices, latest_history
from tests.conftest import SMOKE_DIR
from tests.helpers import rows_of


def test_incremental_ingest(spark):
    base = scratch_path(spark, "stream-test")
    feed = fixtures.house_feed(spark, SMOKE_DIR)
    years = ["1995", "1996", "1997"]
    # one feed folder per year, written in time order
    for y in years:
        part = feed.filter(F.col("scraped_date").startswith(y))
        part.select(*[F.col(c).alias(c.upper()) for c in part.columns]).write.option("header", True).csv(
            os.path.join(base, "feed", y))
    raw, hist, ckpt = (os.path.join(base, d) for d in ("raw", "history", "ckpt"))
    ingest_feed(spark, os.path.join(base, "feed", "*", "*.csv"), raw, hist, ckpt)

    expected = feed.filter(F.substring("scraped_date", 1, 4).isin(years))
    loaded = spark.read.parquet(raw)
    assert loaded.count() == expected.count()
    assert loaded.agg(F.sum("price")).first()[0] == expected.agg(F.sum("price")).first()[0]

    h = latest_history(spark, hist)
    open_ = current_rows(h)
    # one open version per listing, holding the listing's latest scrape date
    assert open_.groupBy("listing_id").count().filter("count > 1").count() == 0
    latest = expected.groupBy("listing_id").agg(F.max("scraped_date").alias("scraped_date"))
    got = open_.select("listing_id", "scraped_date")
    assert got.exceptAll(latest).count() == 0 and latest.exceptAll(got).count() == 0
    # versions never overlap: every closed version ends where a later one starts
    closed = h.filter(F.col("valid_to").isNotNull())
    assert closed.filter(F.col("valid_to") <= F.col("valid_from")).count() == 0

    # a second run with no new files changes nothing
    before = h.count()
    ingest_feed(spark, os.path.join(base, "feed", "*", "*.csv"), raw, hist, ckpt)
    assert latest_history(spark, hist).count() == before


def test_ingest_files_without_rows(spark):
    """A batch of header-only files writes nothing and leaves the history as it is; rows that follow are merged."""
    base = scratch_path(spark, "stream-empty")
    feed = fixtures.house_feed(spark, SMOKE_DIR)
    upper = feed.select(*[F.col(c).alias(c.upper()) for c in feed.columns])
    raw, hist, ckpt, folder = (os.path.join(base, d) for d in ("raw", "history", "ckpt", "feed"))
    for name, rows in (("a", upper.limit(0)), ("b", upper.filter("SCRAPED_DATE LIKE '1995%'"))):
        rows.coalesce(1).write.option("header", True).csv(os.path.join(folder, name))
        ingest_feed(spark, os.path.join(folder, "*", "*.csv"), raw, hist, ckpt)
        if name == "a":
            assert (h := latest_history(spark, hist)) is None or h.count() == 0
    assert spark.read.parquet(raw).count() == feed.filter("scraped_date LIKE '1995%'").count() > 0
    assert current_rows(latest_history(spark, hist)).count() == feed.filter("scraped_date LIKE '1995%'").select("listing_id").distinct().count()


def _months_as_files(spark, base, months):
    """One file per month and its rows as the stream will see them."""
    feed = fixtures.house_feed(spark, SMOKE_DIR)
    for m in months:
        part = feed.filter(F.col("scraped_date").startswith(m))
        part.select(*[F.col(c).alias(c.upper()) for c in part.columns]).coalesce(1).write.option("header", True).csv(os.path.join(base, "feed", m))
    loaded = fill_defaults(coerce_types(feed, schemas.HOUSE_TYPES), schemas.HOUSE_FILL)
    return loaded.filter(F.substring("scraped_date", 1, 7).isin(months))


def test_slices_are_kept_by_the_stream(spark):
    """All slices equal their bulk histories; a batch repeated after its commit changes nothing; only named open versions stay."""
    base = scratch_path(spark, "stream-slices")
    rows = _months_as_files(spark, base, ["1995-03", "1996-05", "1997-02"])
    raw, ckpt = os.path.join(base, "raw"), os.path.join(base, "ckpt")
    store = SnapshotStore(spark, os.path.join(base, "history"), natural_slices(), buckets=4)
    ingest_slices(spark, os.path.join(base, "feed", "*", "*.csv"), raw, store, ckpt, keep=1)

    def check(expected):
        assert spark.read.parquet(raw).count() == expected.count()
        for name, s in store.slices.items():
            whole = scd2_bulk(expected.select(*s.columns), s.key, s.updated_at, s.order_by, s.tie_break)
            assert rows_of(store.read(name), *whole.columns) == rows_of(whole)
    check(rows)
    assert store.read("host").filter("valid_to IS NOT NULL").count() > 0
    named = set(store.last().slices["host"].open.values())
    assert {int(d[4:]) for d in os.listdir(f"{store.path}/host") if os.path.exists(f"{store.path}/host/{d}/part=open")} == named

    # the stream did not note its last batch, though the store had it
    assert store.last().run == 2
    for name in ("2", ".2.crc"):
        if os.path.exists(os.path.join(ckpt, "commits", name)):
            os.remove(os.path.join(ckpt, "commits", name))
    ingest_slices(spark, os.path.join(base, "feed", "*", "*.csv"), raw, store, ckpt, keep=1)
    assert store.last().run == 2
    check(rows)

    # a stream with a checkpoint of its own adds its files to the same store
    more = _months_as_files(spark, os.path.join(base, "later"), ["1998-04"])
    ingest_slices(spark, os.path.join(base, "later", "feed", "*", "*.csv"), raw, store, os.path.join(base, "ckpt-2"), keep=1)
    assert store.last().run == 3
    check(rows.unionByName(more))


def test_a_batch_that_dies_before_its_commit_is_taken_again(spark, monkeypatch):
    base = scratch_path(spark, "stream-slices")
    rows = _months_as_files(spark, base, ["1995-03", "1996-05"])
    raw, ckpt, glob = os.path.join(base, "raw"), os.path.join(base, "ckpt"), os.path.join(base, "feed", "*", "*.csv")
    store = SnapshotStore(spark, os.path.join(base, "history"), natural_slices(), buckets=4)
    run, calls = SnapshotStore.run, []

    def dies(self, batch, source=None):
        calls.append(source)
        if len(calls) == 2:
            with monkeypatch.context() as m:
                m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
                return run(self, batch, source)
        return run(self, batch, source)
    with monkeypatch.context() as m:
        m.setattr(SnapshotStore, "run", dies)
        with pytest.raises(Exception):
            ingest_slices(spark, glob, raw, store, ckpt)
    assert store.last().run == 0 and os.path.exists(f"{store.path}/host/run=1")
    ingest_slices(spark, glob, raw, store, ckpt)
    assert store.last().run == 1 and store.run_of(calls[1]) == 1 and spark.read.parquet(raw).count() == rows.count()
    for name, s in store.slices.items():
        whole = scd2_bulk(rows.select(*s.columns), s.key, s.updated_at, s.order_by, s.tie_break)
        assert rows_of(store.read(name), *whole.columns) == rows_of(whole)
