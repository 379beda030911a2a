"""Lossless loading: CSV quoting, columns by name, ids without limits, histories batch by batch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from staylake.functions.dates import HOST_SINCE_FORMAT, parse_date
from staylake.operators.history import scd2_bulk, scd2_merge
from staylake.operators.quality import check_unique
from staylake.session import scratch_path
from staylake.sources import schemas
from staylake.sources.feeds import coerce_types, house_ids, read_months_csv, surrogate_id
from staylake.streaming import ingest_feed, latest_history

COLUMNS = [f.name for f in schemas.HOUSE_FEED.fields]


def _line(columns, **values):
    row = {"listing_id": "1", "scraped_date": "2020-05-01", "host_id": "7", "host_name": "Ann", "price": "10", **values}
    return ",".join('"' + row[c].replace('"', '""') + '"' if any(x in row.get(c, "") for x in '",\n') else row.get(c, "") for c in columns)


def _file(folder, name, columns, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([",".join(columns).upper(), *lines]) + "\n")
    return path


@pytest.mark.parametrize("multi_line", [False, True])
def test_quotes_and_months_by_name(spark, multi_line):
    folder = scratch_path(spark, "csv").removeprefix("file://")
    names = ['Ann "B, C" D', 'say ""', "x\ny" if multi_line else "x y"]
    a = _file(folder, "05_2020.csv", COLUMNS, [_line(COLUMNS, listing_id=str(i), host_name=n) for i, n in enumerate(names)])
    swapped = [*COLUMNS[1:], COLUMNS[0]]
    lacking = [c for c in COLUMNS if c != "number_of_reviews"] + ["new_column"]
    b = _file(folder, "06_2020.csv", swapped, [_line(swapped, listing_id="8", host_name='E, "F"')])
    c = _file(folder, "07_2020.csv", lacking, [_line(lacking, listing_id="9")])
    got = read_months_csv(spark, "house", [a, b, c], multi_line)
    assert got.columns == COLUMNS
    assert {r.listing_id: r.host_name for r in got.collect()} == {0: names[0], 1: names[1], 2: names[2], 8: 'E, "F"', 9: "Ann"}
    assert got.filter("listing_id = 9").first().number_of_reviews is None


def test_ids_have_no_limits(spark):
    rows = spark.range(100).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("listing_id", "scraped_date")
                                     else F.lit(10 ** 17 + 3 if f.name == "listing_id" else "2020-05-01").cast(f.dataType).alias(f.name)
                                     for f in schemas.HOUSE_FEED.fields])
    same = rows.unionByName(rows.withColumn("listing_id", F.lit(5).cast("bigint")))
    ids = house_ids(same)
    assert ids.count() == 200 and check_unique(ids, "id").count() == 0
    assert ids.filter("listing_id = 5 AND id > 0").count() == 64
    keyed = surrogate_id(spark.range(3).withColumn("k", F.lit(2)), F.col("k"), ["k"], ["id"], name="key")
    assert sorted(r.key for r in keyed.collect()) == [129, 130, 131]


def test_bigint_text_keeps_its_digits(spark):
    df = spark.createDataFrame([("1234567890123456789",), ("2.5",), ("-2.5",), ("x",), (None,), ("99999999999999999999",)], "v string")
    assert [r.v for r in coerce_types(df, {"v": "bigint"}).collect()] == [1234567890123456789, 3, -3, None, None, None]


def test_merge_equals_bulk_with_gaps(spark):
    """NULL keys, missing dates and several dates per key in a batch, in time order."""
    rnd = random.Random(5)
    ddl = "id bigint, k bigint, since string, v string"
    order = lambda c: parse_date(c, HOST_SINCE_FORMAT)
    batches, n = [], 0
    for day in range(0, 12, 3):
        rows = []
        for k in [None, *range(8)]:
            for d in range(day, day + 3):
                if rnd.random() < 0.5:
                    n += 1
                    rows.append((n, k, "" if d == 0 else f"{d}/2/2020", f"v{n}"))
                    if rnd.random() < 0.3:
                        n += 1
                        rows.append((n, k, rows[-1][2], f"v{n}"))
        batches.append(rows)
    history = scd2_bulk(spark.createDataFrame([], ddl), "k", "since", unique_key=True)
    for b in batches:
        history = scd2_merge(history, spark.createDataFrame(b, ddl), "k", "since", order)
    bulk = scd2_bulk(spark.createDataFrame([r for b in batches for r in b], ddl), "k", "since", order)
    cols = ["id", "k", "since", "v", "scd_id", "valid_from", "valid_to"]
    assert bulk.filter("valid_to IS NOT NULL").count() > 10
    assert sorted(map(str, history.select(*cols).collect())) == sorted(map(str, bulk.select(*cols).collect()))


@pytest.mark.parametrize("files_per_batch", [1, 4])
def test_stream_does_not_depend_on_batches(spark, files_per_batch):
    base = scratch_path(spark, "stream")
    folder = base.removeprefix("file://") + "/feed"
    columns = ["id", *COLUMNS]
    for i, (listing, day) in enumerate([("1", "2020-05-01"), ("2", "2020-05-01"), ("1", "2020-05-20"), ("1", "2020-06-01")]):
        path = _file(folder, f"{i}.csv", columns, [_line(columns, id=str(i), listing_id=listing, scraped_date=day, host_name='a ""b"", c')])
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    ingest_feed(spark, f"{base}/feed/*.csv", f"{base}/raw", f"{base}/history", f"{base}/checkpoint", files_per_batch=files_per_batch)
    raw = spark.read.parquet(f"{base}/raw")
    assert raw.count() == 4 and {r.host_name for r in raw.collect()} == {'a ""b"", c'}
    got = sorted((r.listing_id, r.valid_from, r.valid_to) for r in latest_history(spark, f"{base}/history").collect())
    assert [g[:2] for g in got] == [(1, "2020-05-01"), (1, "2020-05-20"), (1, "2020-06-01"), (2, "2020-05-01")]
    assert [g[2] for g in got] == ["2020-05-20", "2020-06-01", None, None]


def test_stream_checks_headers(spark):
    base = scratch_path(spark, "stream")
    columns = ["id", *COLUMNS]
    columns[2], columns[4] = columns[4], columns[2]
    _file(base.removeprefix("file://") + "/feed", "0.csv", columns, [_line(columns, id="0")])
    with pytest.raises(Exception):
        ingest_feed(spark, f"{base}/feed/*.csv", f"{base}/raw", f"{base}/history", f"{base}/checkpoint")
