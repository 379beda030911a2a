"""The five raw feeds derived from the driver's TPC-H-like test tables.

The listings feed, LGA lists and census tables are not shipped with the
test data, so they are derived from it by rules that both Spark and the
DuckDB oracle evaluate identically (see FIXTURES.md):

* a listing row is a line item, its host is the order, its host neighbourhood
  the customer's nation and its listing neighbourhood the supplier's nation;
* an LGA is a region and a suburb is a nation, for the nations and regions
  where customers live; nation 0 is also listed under the next region, so one
  suburb lies in two LGAs;
* census counts are customer counts per region; census medians (for regions
  with customers) are linear in the region key, with fractional averages
  that must be rounded on load.

``SPARK`` builders return DataFrames; ``fixture_ctes()`` returns the same
tables as SQL common table expressions over the registered test views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.sources import schemas
from staylake.sources.feeds import coerce_types, fill_defaults, surrogate_id

# ---- fixed values: derivation parameters (FIXTURES.md section 2) -----------
HOST_NAME_GAP_EVERY = 17        # host_name missing when o_orderkey % 17 = 0
HOST_SINCE_GAP_EVERY = 19       # host_since missing when o_orderkey % 19 = 0
HOST_SINCE_ORIGIN = "2010-01-01"
HOST_SINCE_SPAN_DAYS = 3000
SUPERHOST_BALANCE = 5000
PRICE_MODULUS = 500
LGA_CODE_BASE = 10000
CENSUS_FAMILY_MODULUS = 36
LINE_SLOTS = 8                  # line numbers 1..7
COPY_SLOTS = 64                 # rows sharing (orderkey, linenumber)
LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

# census_two measures: (intercept, slope per region key, divisor); a divisor
# other than 1 gives the fractional averages of the real feed.
CENSUS_TWO_RULES = {
    "median_age_persons": (30, 1, 1),
    "median_mortgage_repay_monthly": (100, 150, 1),
    "median_tot_prsnl_inc_weekly": (500, 40, 1),
    "median_rent_weekly": (300, 25, 1),
    "median_tot_fam_inc_weekly": (1500, 90, 1),
    "average_num_psns_per_bedroom": (1, 1, 2),
    "median_tot_hhd_inc_weekly": (1200, 70, 1),
    "average_household_size": (21, 2, 10),
}


# Lookup tables are broadcast once their row count is checked against these
# bounds (suppliers are read with two numbers a row; the other tables grow with the data).
LOOKUP_MAX_ROWS = {"nation": 10_000, "region": 10_000, "supplier": 1_000_000}


_LOOKUP_SMALL: dict[tuple[str, str], bool] = {}


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path).select(*cols)
    if name not in LOOKUP_MAX_ROWS:
        return df
    key = (spark.sparkContext.applicationId, path)
    if key not in _LOOKUP_SMALL:  # check each lookup file once per session
        most = LOOKUP_MAX_ROWS[name]
        _LOOKUP_SMALL[key] = spark.read.parquet(path).limit(most + 1).count() <= most
    return F.broadcast(df) if _LOOKUP_SMALL[key] else df


# ----------------------------------------------------------------------------
# Spark builders
# ----------------------------------------------------------------------------

def house_feed(spark: SparkSession, sf_dir: str, by_listing: bool = False) -> DataFrame:
    """Monthly listings feed rows as they arrive (with gaps), plus the row id. ``by_listing``: all rows of a
    listing come from one task, by the move that brings lines to their parts."""
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *LINEITEM_ORDER])
    orders = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    cust = _read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    part = _read(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"])
    supp = _read(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                       F.col("n_name").alias("host_neighbourhood"))
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"),
                       F.col("n_name").alias("listing_neighbourhood"))

    # Customers meet the orders, not the line items, which are several times as many. They come as a list per
    # key, so that the order lines keep their count until they are numbered: numbers are given
    # before a line without a customer is dropped or one with several is repeated.
    hosts = (cust.filter(F.col("c_custkey").isNotNull() & F.col("c_nationkey").isNotNull())
             .groupBy("c_custkey").agg(F.collect_list(F.struct(
                 "c_name", "c_nationkey", (F.col("c_acctbal") > SUPERHOST_BALANCE).alias("host_is_superhost"))).alias("_hosts")))
    orders = orders.join(hosts, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")

    # Join orders first: the surrogate-key window partitions by
    # (l_orderkey, l_linenumber), which the orderkey partitioning of a
    # shuffled join already satisfies, so the window adds no exchange.
    rows = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = surrogate_id(
        rows,
        base=F.when(F.col("l_linenumber").between(0, LINE_SLOTS - 1), F.col("l_orderkey") * LINE_SLOTS + F.col("l_linenumber")),
        partition=["l_orderkey", "l_linenumber"],
        order=LINEITEM_ORDER, copies=COPY_SLOTS)
    # the figures of a row are small numbers; only these, and no longer what they come from, are moved further,
    # with the keys of nations instead of their names and the day instead of the time
    rows = rows.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select(
        "id", "l_partkey", "s_nationkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"), "o_orderkey", "o_orderpriority",
        (F.floor("l_extendedprice").cast("int") % PRICE_MODULUS).alias("price"),
        (F.col("l_linestatus") == "O").alias("has_availability"),
        F.floor("l_quantity").cast("int").alias("qty"),
        (F.round(F.col("l_tax") * 100).cast("int") + 1).alias("tax_score"),
        (F.round(F.col("l_discount") * 100).cast("int") + 1).alias("discount_score"),
        F.inline("_hosts"))
    if by_listing:
        rows = rows.repartition("l_partkey")
    rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey")).join(sn, "s_nationkey").join(cn, "c_nationkey")

    o = F.col("o_orderkey")
    qty, tax_score, discount_score = F.col("qty"), F.col("tax_score"), F.col("discount_score")
    since = F.date_format(
        F.date_add(F.lit(HOST_SINCE_ORIGIN).cast("date"), (o % HOST_SINCE_SPAN_DAYS).cast("int")),
        "dd/MM/yyyy")
    return rows.select(
        F.col("id"),
        F.col("l_partkey").alias("listing_id"),
        F.date_format("l_shipdate", "yyyyMM").alias("scrape_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("scraped_date"),
        o.alias("host_id"),
        F.when(o % HOST_NAME_GAP_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_name")).alias("host_name"),
        F.when(o % HOST_SINCE_GAP_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(since).alias("host_since"),
        F.col("host_is_superhost"),
        F.col("host_neighbourhood"),
        F.col("listing_neighbourhood"),
        F.col("p_type").alias("property_type"),
        F.col("o_orderpriority").alias("room_type"),
        (F.col("p_size") % 8 + 1).alias("accommodates"),
        F.col("price"),
        F.col("has_availability"),
        (qty % 31).alias("availability_30"),
        qty.alias("number_of_reviews"),
        tax_score.alias("review_scores_rating"),
        discount_score.alias("review_scores_accuracy"),
        (qty % 10 + 1).alias("review_scores_cleanliness"),
        F.col("l_linenumber").alias("review_scores_checkin"),
        tax_score.alias("review_scores_communication"),
        discount_score.alias("review_scores_value"),
    )


def house(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.house``: the feed after gap filling and coercion."""
    feed = house_feed(spark, sf_dir)
    loaded = fill_defaults(coerce_types(feed, schemas.HOUSE_TYPES), schemas.HOUSE_FILL)
    return loaded.select("id", *schemas.HOUSE_COLUMNS)


def _customer_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (nation, region) pairs where customers live: the census
    covers inhabited areas, and deriving it scans the customer table."""
    cust = _read(spark, sf_dir, "customer", ["c_nationkey"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = _read(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_nationkey", "n_name", "n_regionkey").distinct()
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))


def lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One LGA per region with customers."""
    return _customer_areas(spark, sf_dir).select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
        (F.col("r_regionkey") + LGA_CODE_BASE).cast("int").alias("lga_code"),
        F.col("r_name").alias("lga_name")).distinct()


def lga_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One suburb per nation with customers, under its region's LGA."""
    areas = _customer_areas(spark, sf_dir)
    region = _read(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    home = areas.select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("id"),
        F.col("r_name").alias("lga_name"), F.col("n_name").alias("suburb_name"))
    # Nation 0 is also listed under the next region: one suburb, two LGAs.
    nxt = region.select(F.col("r_regionkey").alias("next_key"), F.col("r_name").alias("next_name"))
    planted = (areas.filter(F.col("n_nationkey") == 0)
               .join(nxt, F.col("next_key") == F.col("n_regionkey") + 1)
               .select((F.col("n_nationkey") + 1001).cast("bigint").alias("id"),
                       F.col("next_name").alias("lga_name"), F.col("n_name").alias("suburb_name")))
    return home.unionByName(planted)


def census_two_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G02 medians per region with customers, as the feed carries them
    (averages are fractional)."""
    regions = _customer_areas(spark, sf_dir).select("r_regionkey").distinct()
    r = F.col("r_regionkey")
    measures = [((F.lit(a) + F.lit(b) * r).cast("double") / F.lit(d)).alias(name)
                for name, (a, b, d) in CENSUS_TWO_RULES.items()]
    return regions.select(
        (r + 1).cast("bigint").alias("id"),
        F.concat(F.lit("LGA"), (r + LGA_CODE_BASE).cast("string")).alias("lga_code_2016"),
        *measures)


def census_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_types(census_two_feed(spark, sf_dir), schemas.CENSUS_TWO_TYPES)


def census_one_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G01 counts: per region, customers with ``c_custkey % 36`` = family
    position; M and F split on the parity of ``c_custkey div 36``; P is both.

    The customer scan is first reduced to (region, family, half) counts, so
    the wide pivot runs on at most regions x 72 rows.
    """
    region = _read(spark, sf_dir, "region", ["r_regionkey"])
    nation = _read(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    cust = _read(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    m = CENSUS_FAMILY_MODULUS
    counts = (cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .groupBy("n_regionkey",
                       (F.col("c_custkey") % m).alias("fam"),
                       (F.call_function("div", F.col("c_custkey"), F.lit(m)) % 2).alias("half"))
              .agg(F.count("*").alias("n")))
    aggs = []
    for k, family in enumerate(schemas.CENSUS_ONE_FAMILIES):
        base = F.col("fam") == k
        for sfx, cond in (("m", base & (F.col("half") == 0)),
                          ("f", base & (F.col("half") == 1)),
                          ("p", base)):
            aggs.append(F.sum(F.when(cond, F.col("n")).otherwise(0)).alias(f"{family.lower()}_{sfx}"))
    wide = counts.groupBy("n_regionkey").agg(*aggs)
    cols = schemas.census_one_columns()
    joined = region.join(wide, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return joined.select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
        F.concat(F.lit("LGA"), (F.col("r_regionkey") + LGA_CODE_BASE).cast("string")).alias("lga_code_2016"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in cols])


def census_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_types(census_one_feed(spark, sf_dir), schemas.CENSUS_ONE_TYPES)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five raw tables, lazily."""
    return {
        "house": house(spark, sf_dir),
        "nsw_lga_code": lga_code(spark, sf_dir),
        "nsw_lga_suburb": lga_suburb(spark, sf_dir),
        "census_one": census_one(spark, sf_dir),
        "census_two": census_two(spark, sf_dir),
    }


# ----------------------------------------------------------------------------
# The same tables as SQL (DuckDB dialect) for the oracle
# ----------------------------------------------------------------------------

def _census_one_sql() -> str:
    m = CENSUS_FAMILY_MODULUS
    cols = []
    for k, family in enumerate(schemas.CENSUS_ONE_FAMILIES):
        f = family.lower()
        cols.append(f"CAST(count_if(c.c_custkey % {m} = {k} AND (c.c_custkey // {m}) % 2 = 0) AS INTEGER) AS {f}_m")
        cols.append(f"CAST(count_if(c.c_custkey % {m} = {k} AND (c.c_custkey // {m}) % 2 = 1) AS INTEGER) AS {f}_f")
        cols.append(f"CAST(count_if(c.c_custkey % {m} = {k}) AS INTEGER) AS {f}_p")
    per_region = (
        "SELECT n.n_regionkey, " + ", ".join(cols) +
        " FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_regionkey")
    outer = ", ".join(f"coalesce(w.{c}, 0) AS {c}" for c in schemas.census_one_columns())
    return (f"SELECT CAST(r.r_regionkey + 1 AS BIGINT) AS id, "
            f"'LGA' || CAST(r.r_regionkey + {LGA_CODE_BASE} AS VARCHAR) AS lga_code_2016, {outer} "
            f"FROM region r LEFT JOIN ({per_region}) w ON r.r_regionkey = w.n_regionkey")


AREAS_SQL = ("SELECT DISTINCT n.n_nationkey, n.n_name, n.n_regionkey, r.r_regionkey, r.r_name "
             "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey "
             "JOIN region r ON n.n_regionkey = r.r_regionkey")


def _census_two_sql(loaded: bool) -> str:
    parts = []
    for name, (a, b, d) in CENSUS_TWO_RULES.items():
        value = f"CAST({a} + {b} * r_regionkey AS DOUBLE) / {d}"
        parts.append(f"CAST(round({value}) AS INTEGER) AS {name}" if loaded else f"{value} AS {name}")
    return (f"SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, "
            f"'LGA' || CAST(r_regionkey + {LGA_CODE_BASE} AS VARCHAR) AS lga_code_2016, "
            + ", ".join(parts) + " FROM (SELECT DISTINCT r_regionkey FROM customer_areas) a")


def _house_feed_sql() -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in LINEITEM_ORDER)
    return f"""SELECT li.id,
  li.l_partkey AS listing_id,
  strftime(li.l_shipdate, '%Y%m') AS scrape_id,
  strftime(li.l_shipdate, '%Y-%m-%d') AS scraped_date,
  o.o_orderkey AS host_id,
  CASE WHEN o.o_orderkey % {HOST_NAME_GAP_EVERY} = 0 THEN NULL ELSE c.c_name END AS host_name,
  CASE WHEN o.o_orderkey % {HOST_SINCE_GAP_EVERY} = 0 THEN NULL
       ELSE strftime(DATE '{HOST_SINCE_ORIGIN}' + CAST(o.o_orderkey % {HOST_SINCE_SPAN_DAYS} AS INTEGER), '%d/%m/%Y') END AS host_since,
  c.c_acctbal > {SUPERHOST_BALANCE} AS host_is_superhost,
  cn.n_name AS host_neighbourhood,
  sn.n_name AS listing_neighbourhood,
  p.p_type AS property_type,
  o.o_orderpriority AS room_type,
  p.p_size % 8 + 1 AS accommodates,
  CAST(floor(li.l_extendedprice) AS INTEGER) % {PRICE_MODULUS} AS price,
  li.l_linestatus = 'O' AS has_availability,
  CAST(floor(li.l_quantity) AS INTEGER) % 31 AS availability_30,
  CAST(floor(li.l_quantity) AS INTEGER) AS number_of_reviews,
  CAST(round(li.l_tax * 100) AS INTEGER) + 1 AS review_scores_rating,
  CAST(round(li.l_discount * 100) AS INTEGER) + 1 AS review_scores_accuracy,
  CAST(floor(li.l_quantity) AS INTEGER) % 10 + 1 AS review_scores_cleanliness,
  li.l_linenumber AS review_scores_checkin,
  CAST(round(li.l_tax * 100) AS INTEGER) + 1 AS review_scores_communication,
  CAST(round(li.l_discount * 100) AS INTEGER) + 1 AS review_scores_value
FROM (SELECT *, (l_orderkey * {LINE_SLOTS} + l_linenumber) * {COPY_SLOTS}
                + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS id
      FROM lineitem) li
JOIN orders o ON li.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN part p ON li.l_partkey = p.p_partkey
JOIN supplier s ON li.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey"""


def _house_sql() -> str:
    cols = []
    for c in schemas.HOUSE_COLUMNS:
        if c in schemas.HOUSE_FILL:
            v = schemas.HOUSE_FILL[c]
            lit = "''" if v == "" else ("false" if v is False else str(v))
            cols.append(f"coalesce({c}, {lit}) AS {c}")
        else:
            cols.append(c)
    return "SELECT id, " + ", ".join(cols) + " FROM feed_house"


def fixture_ctes() -> list[tuple[str, str]]:
    """(name, SQL) pairs, in dependency order."""
    return [
        ("feed_house", _house_feed_sql()),
        ("raw_house", _house_sql()),
        ("customer_areas", AREAS_SQL),
        ("raw_lga_code", f"SELECT DISTINCT CAST(r_regionkey + 1 AS BIGINT) AS id, "
                         f"CAST(r_regionkey + {LGA_CODE_BASE} AS INTEGER) AS lga_code, "
                         f"r_name AS lga_name FROM customer_areas"),
        ("raw_lga_suburb",
         "SELECT CAST(a.n_nationkey + 1 AS BIGINT) AS id, a.r_name AS lga_name, a.n_name AS suburb_name "
         "FROM customer_areas a "
         "UNION ALL "
         "SELECT CAST(a.n_nationkey + 1001 AS BIGINT), r.r_name, a.n_name "
         "FROM customer_areas a JOIN region r ON r.r_regionkey = a.n_regionkey + 1 WHERE a.n_nationkey = 0"),
        ("feed_census_two", _census_two_sql(loaded=False)),
        ("raw_census_two", _census_two_sql(loaded=True)),
        ("raw_census_one", _census_one_sql()),
    ]
