"""Plan shape: the properties that matter at scale."""

from staylake.plans import marts, questions
from staylake.plans.warehouse import Warehouse
from tests.conftest import SMOKE_DIR


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _wh(spark):
    return Warehouse.from_testdata(spark, SMOKE_DIR, materialized=True)


def test_marts_do_not_join_listings_to_themselves(spark):
    wh = _wh(spark)
    for df in (marts.dm_listing_neighbourhood(wh, sort=False), marts.dm_property_type(wh, sort=False)):
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the only join is the small distinct-host aggregate joined back on the group keys
        assert plan.count("Join") <= 1


def test_lga_lookups_are_broadcast(spark):
    wh = _wh(spark)
    plan = _plan(marts.dm_host_neighbourhood(wh, sort=False))
    assert "BroadcastHashJoin" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    wh = _wh(spark)
    df = questions.neighbourhood_revenue(wh)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,5)]" in plan
    assert "host_name" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_top1_per_group_is_limited_per_task(spark):
    wh = _wh(spark)
    rooms = questions.best_room_per_neighbourhood(questions.room_revenue_stays(wh))
    assert "WindowGroupLimit" in rooms._jdf.queryExecution().optimizedPlan().toString()


def test_q1_has_one_single_partition_exchange_and_no_window(spark):
    wh = _wh(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(questions.q1_best_worst(wh))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange SinglePartition") == 1  # the final one-row-per-task aggregate
    assert "Window" not in plan
