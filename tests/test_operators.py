from pyspark.sql import functions as F

from staylake.operators import (bounded_broadcast, check_unique, current_rows, first_last,
                                host_room_spread, period_change, scd2_bulk, scd2_merge,
                                top1_per_group, top_k)
from staylake.functions.dates import parse_date
from tests.helpers import rows_of

ORDER = [("rev", True), ("pop", True), ("name", False)]


def test_first_last_two_rows_and_ties(spark):
    df = spark.createDataFrame([("a", 10, 5), ("b", 10, 7), ("c", 3, 1), ("d", None, 9)],
                               "name string, rev long, pop long")
    got = rows_of(first_last(df, ORDER), "name")
    # b beats a on population; d has NULL revenue so it ranks last
    assert got == [("b",), ("d",)]


def test_first_last_single_and_empty(spark):
    one = spark.createDataFrame([("a", 1, 1)], "name string, rev long, pop long")
    assert first_last(one, ORDER).count() == 1
    assert first_last(one.filter("rev > 5"), ORDER).count() == 0


def test_first_last_has_no_single_partition_window(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("name"), F.col("id").alias("rev"),
                                 F.lit(1).cast("long").alias("pop"))
    plan = first_last(df, ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert sorted(r.name for r in first_last(df, ORDER).collect()) == ["0", "99"]


def test_top1_per_group_ties_and_plan(spark):
    df = spark.createDataFrame([("x", "A", 5), ("x", "B", 5), ("x", "C", 1), ("y", "A", 2)],
                               "g string, k string, v long")
    out = top1_per_group(df, ["g"], [("v", True), ("k", False)])
    assert rows_of(out) == [("x", "A", 5), ("y", "A", 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_k_breaks_ties_on_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None)], "k string, v long")
    assert [r.k for r in top_k(df, 3, [("v", True), ("k", False)]).collect()] == ["c", "a", "b"]


def test_host_room_spread_counts_null_as_a_value(spark):
    df = spark.createDataFrame(
        [(1, "A", "R", 2), (1, "A", "R", 2), (2, "A", "R", 2), (2, "A", None, 2), (3, None, None, 1),
         (3, None, None, 1), (None, "A", "R", 1), (None, "B", "R", 1)],
        "host_id long, property_type string, room_type string, accommodates int")
    got = rows_of(host_room_spread(df), "host_id", "multi")
    assert got == [(1, False), (2, True), (3, False)]


def test_check_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows_of(check_unique(df, "k")) == [(1, 2)]
    assert check_unique(df, ["k", "v"]).count() == 0


def test_period_change_next_previous_and_zero(spark):
    df = spark.createDataFrame([("a", "01", 4), ("a", "02", 6), ("a", "03", 0), ("a", "04", 3)],
                               "g string, m string, n long")
    nxt = period_change(df, "n", ["g"], "m", "chg")
    assert [r.chg for r in nxt.orderBy("m").collect()] == [50.0, -100.0, None, None]
    prev = period_change(df, "n", ["g"], "m", "chg", direction="previous")
    assert [r.chg for r in prev.orderBy("m").collect()] == [None, 50.0, -100.0, None]


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id long, k long, d string, v string")


def _dmy(c):
    return parse_date(c, "d/M/yyyy")


def test_scd2_bulk_versions_and_text_dates(spark):
    # text order of these dates is not time order (D10)
    df = _batch(spark, [(1, 7, "02/01/2020", "a"), (2, 7, "01/12/2021", "b"), (3, 7, "01/12/2021", "c"),
                        (4, 8, "05/05/2020", "x")])
    h = scd2_bulk(df, "k", "d", order_by=_dmy)
    got = rows_of(h, "k", "v", "valid_from", "valid_to")
    assert got == [(7, "a", "02/01/2020", "01/12/2021"), (7, "b", "01/12/2021", None),
                   (8, "x", "05/05/2020", None)]
    assert current_rows(h).count() == 2


def test_scd2_merge_incremental_equals_bulk(spark):
    batches = [
        [(1, 1, "2020-01-01", "a"), (2, 2, "2020-01-01", "p")],
        [(3, 1, "2020-02-01", "b"), (4, 3, "2020-02-01", "z")],
        [(5, 1, "2020-01-15", "old"), (6, 2, "2020-03-01", "q")],  # an older row for key 1: no change
    ]
    history = scd2_bulk(_batch(spark, batches[0]), "k", "d", unique_key=True)
    for b in batches[1:]:
        history = scd2_merge(history, _batch(spark, b), "k", "d")
    got = rows_of(history, "k", "v", "valid_from", "valid_to")
    assert got == [(1, "a", "2020-01-01", "2020-02-01"), (1, "b", "2020-02-01", None),
                   (2, "p", "2020-01-01", "2020-03-01"), (2, "q", "2020-03-01", None),
                   (3, "z", "2020-02-01", None)]
    # one open version per key; re-running the last batch changes nothing
    again = scd2_merge(history, _batch(spark, batches[2]), "k", "d")
    assert rows_of(again, "k", "v", "valid_from", "valid_to") == got
    assert current_rows(history).groupBy("k").count().filter("count > 1").count() == 0


def test_bounded_broadcast_checks_size(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).withColumnRenamed("id", "k")
    hinted = big.join(bounded_broadcast(small, max_rows=10), "k")
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unhinted = big.join(bounded_broadcast(small, max_rows=5), "k")
        assert "BroadcastHashJoin" not in unhinted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scd2_bulk_same_date_spelled_twice(spark):
    df = _batch(spark, [(1, 7, "7/1/2013", "a"), (2, 7, "07/01/2013", "b"), (3, 7, "08/01/2013", "c")])
    h = scd2_bulk(df, "k", "d", order_by=_dmy)
    assert rows_of(h, "v", "valid_from", "valid_to") == [("a", "7/1/2013", "08/01/2013"), ("c", "08/01/2013", None)]
