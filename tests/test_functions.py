
from staylake.functions import (estimated_nights, estimated_revenue, label_time_key,
                                lga_code_parse, month_label, parse_date, pct, ratio)


def _one(spark, expr, data, ddl):
    return [r[0] for r in spark.createDataFrame(data, ddl).select(expr).collect()]


def test_pct_rounds_half_away_from_zero(spark):
    data = [(1, 8), (-1, 8), (1, 3), (2, 3), (0, 5), (5, 0), (None, 4), (3, None), (1, 16)]
    got = _one(spark, pct("a", "b"), data, "a long, b long")
    # 12.5, -12.5, 33.333.., 66.666.., 0, NULL, NULL, NULL, 6.25
    assert got == [12.5, -12.5, 33.33, 66.67, 0.0, None, None, None, 6.25]


def test_ratio_ties_and_negative_denominator(spark):
    data = [(1, 8), (-1, 8), (1, -8), (5, 2), (7, 1), (10 ** 12 + 1, 2)]
    got = _one(spark, ratio("a", "b"), data, "a long, b long")
    assert got == [0.13, -0.13, -0.13, 2.5, 7.0, 500000000000.5]


def test_month_label_text_order_differs_from_time(spark):
    df = spark.createDataFrame([("2020-12-03",), ("2021-01-20",)], "d string")
    df = df.select(month_label(parse_date("d", "yyyy-MM-dd")).alias("m"))
    labels = [r.m for r in df.orderBy("m").collect()]
    assert labels == ["01/2021", "12/2020"]
    by_time = [r.m for r in df.orderBy(label_time_key("m")).collect()]
    assert by_time == ["12/2020", "01/2021"]


def test_parse_host_since_variants(spark):
    got = _one(spark, parse_date("s", "d/M/yyyy").cast("string"),
               [("7/1/2013",), ("27/11/2013",), ("",), ("x",), (None,)], "s string")
    assert got == ["2013-01-07", "2013-11-27", None, None, None]


def test_lga_code_parse(spark):
    got = _one(spark, lga_code_parse("c"), [("LGA10050",), ("LGAxx",), (None,)], "c string")
    assert got == [10050, None, None]


def test_estimated_nights_and_revenue_null_rules(spark):
    data = [(True, 10, 100), (False, 10, 100), (None, 10, 100), (True, None, 100), (False, 5, None)]
    ddl = "has_availability boolean, availability_30 int, price int"
    assert _one(spark, estimated_nights(), data, ddl) == [20, 0, 0, None, 0]
    # inactive * NULL price is NULL (the models multiply after the CASE)
    assert _one(spark, estimated_revenue(), data, ddl) == [2000, 0, 0, None, None]


def test_cluster_conf_sizes_shuffles():
    from staylake.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(10, 8)["spark.sql.shuffle.partitions"] == "16"
    assert cluster_conf(100 * 1024 ** 4, 8000, shuffle_bytes=5 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "20480"
