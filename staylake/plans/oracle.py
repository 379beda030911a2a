"""DuckDB SQL twins of every registered query (the correctness oracle).

Each string starts with the fixture tables derived from the registered test
views, then the staging / warehouse models as plain SQL, then the query
itself. The SQL is an independent formulation of the same definitions
(aggregate FILTER clauses, named windows, rank-based top lists), so it checks
the Spark operators rather than repeating them. Ratios
use the same exact integer rounding as ``staylake.functions.exact``.
"""

from __future__ import annotations

from staylake.plans.questions import BANDS_20_34, UNDER_20_BANDS
from staylake.sources import fixtures, schemas


def sql_ratio(num: str, den: str, scale: int = 0, places: int = 2) -> str:
    """``ROUND(num / NULLIF(den, 0) * 10**scale, places)``, half away from zero."""
    a, b = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    f = 2 * 10 ** (scale + places)
    return (f"(CASE WHEN {b} = 0 THEN NULL ELSE (CASE WHEN {a} < 0 THEN -1 ELSE 1 END) * "
            f"((abs({a}) * {f} + {b}) // (2 * {b})) / {10 ** places} END)")


def sql_pct(num: str, den: str, places: int = 2) -> str:
    return sql_ratio(num, den, 2, places)


def _date(expr: str, fmt: str) -> str:
    return f"CAST(try_strptime({expr}, '{fmt}') AS DATE)"


HOST_FMT = "%d/%m/%Y"
SCRAPE_FMT = "%Y-%m-%d"


def _snapshot(name: str, cols: list[str], updated_at: str) -> str:
    return (f"SELECT {', '.join(cols)}, md5(concat_ws('|', CAST(id AS VARCHAR), {updated_at})) AS scd_id, "
            f"{updated_at} AS updated_at, {updated_at} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to "
            f"FROM raw_house")


HOST_COLS = ["id", "host_id", "host_name", "host_since", "host_is_superhost", "host_neighbourhood"]
LISTING_COLS = ["id", "listing_id", "scraped_date", "listing_neighbourhood"]
PROPERTY_COLS = ["id", "scraped_date", "property_type", "room_type", "accommodates", "price",
                 "has_availability", "availability_30"]
REVIEW_COLS = ["id", "scraped_date", "number_of_reviews", *schemas.REVIEW_SCORES]


NIGHTS = "CASE WHEN {a}.has_availability THEN 30 - {a}.availability_30 ELSE 0 END"


def model_ctes() -> list[tuple[str, str]]:
    nights_p = NIGHTS.format(a="p")
    return [
        # history: one open version per row id
        ("host_snapshot", _snapshot("host", HOST_COLS, "host_since")),
        ("listing_snapshot", _snapshot("listing", LISTING_COLS, "scraped_date")),
        ("property_snapshot", _snapshot("property", PROPERTY_COLS, "scraped_date")),
        ("review_snapshot", _snapshot("review", REVIEW_COLS, "scraped_date")),
        # staging
        ("stg_lga_code", "SELECT lga_code, lower(lga_name) AS lga_name FROM raw_lga_code"),
        ("stg_lga_suburb", "SELECT lower(lga_name) AS lga_name, lower(suburb_name) AS suburb_name FROM raw_lga_suburb"),
        ("stg_host", f"SELECT id, host_id, host_name, {_date('host_since', HOST_FMT)} AS host_since, "
                     f"host_is_superhost, lower(host_neighbourhood) AS host_neighbourhood, scd_id, "
                     f"{_date('updated_at', HOST_FMT)} AS updated_at, {_date('valid_from', HOST_FMT)} AS valid_from, "
                     f"valid_to FROM host_snapshot WHERE host_name <> '' AND host_since <> ''"),
        ("stg_listing", f"SELECT id, listing_id, {_date('scraped_date', SCRAPE_FMT)} AS scraped_date, "
                        f"lower(listing_neighbourhood) AS listing_neighbourhood, "
                        f"{_date('updated_at', SCRAPE_FMT)} AS updated_at, {_date('valid_from', SCRAPE_FMT)} AS valid_from, "
                        f"valid_to FROM listing_snapshot"),
        ("stg_property", f"SELECT id, {_date('scraped_date', SCRAPE_FMT)} AS scraped_date, property_type, room_type, "
                         f"accommodates, price, has_availability, availability_30, "
                         f"{_date('updated_at', SCRAPE_FMT)} AS updated_at, {_date('valid_from', SCRAPE_FMT)} AS valid_from, "
                         f"valid_to FROM property_snapshot WHERE price > 5"),
        # warehouse
        ("dim_host", "SELECT * FROM stg_host"),
        ("dim_listing", "SELECT * FROM stg_listing"),
        ("dim_property", "SELECT * FROM stg_property"),
        ("dim_lga", "SELECT c.lga_code, c.lga_name, s.suburb_name FROM stg_lga_code c JOIN stg_lga_suburb s ON s.lga_name = c.lga_name"),
        ("fact_one", "SELECT * FROM raw_census_one"),
        ("fact_two", "SELECT * FROM raw_census_two"),
        ("fact_review", "SELECT * FROM review_snapshot"),
        ("fact_listing_base",
         f"SELECT id AS listing_id, listing_id AS original_listing_id, {_date('scraped_date', SCRAPE_FMT)} AS scraped_date, "
         "host_id, host_name, lower(host_neighbourhood) AS host_neighbourhood, lower(listing_neighbourhood) AS listing_neighbourhood, "
         "property_type, room_type, accommodates, price, has_availability, availability_30, number_of_reviews, review_scores_rating "
         "FROM raw_house WHERE host_name <> '' AND host_since <> '' AND price > 5"),
        ("fact_listing",
         "SELECT b.*, g.lga_name AS listing_neighbourhood_lga, g.suburb_name AS listing_suburb "
         "FROM fact_listing_base b LEFT JOIN dim_lga g ON lower(g.suburb_name) = lower(b.listing_neighbourhood)"),
        # listing rows with all three slices, and with the rating as well
        ("stay_rows",
         "SELECT l.id, l.scraped_date, strftime(l.scraped_date, '%m/%Y') AS month_year, l.listing_neighbourhood, "
         "h.host_id, h.host_name, h.host_is_superhost, h.host_neighbourhood, p.property_type, p.room_type, "
         f"p.accommodates, p.price, p.has_availability, p.availability_30, {nights_p} AS nights "
         "FROM dim_listing l JOIN dim_host h ON h.id = l.id JOIN dim_property p ON p.id = l.id"),
        ("rated_rows", "SELECT s.*, r.review_scores_rating FROM stay_rows s JOIN fact_review r ON r.id = s.id"),
        ("monthly_nb", _monthly_sql("listing_neighbourhood")),
        ("monthly_kind", _monthly_sql("property_type, room_type, accommodates")),
        # one relation of listings with what every slice keeps, and the rows each slice alone would keep
        ("listing",
         "SELECT *, host_name <> '' AND host_since <> '' AS has_host, price > 5 AS has_price, "
         "lower(listing_neighbourhood) AS nb, lower(host_neighbourhood) AS home, "
         "(CASE WHEN has_availability THEN 30 - availability_30 ELSE 0 END) * price AS revenue FROM raw_house"),
        ("age_profile", _age_profile_sql()),
        ("nb_revenue",
         "SELECT nb AS listing_neighbourhood, CAST(sum(revenue) AS BIGINT) AS estimate_revenue FROM listing WHERE has_price GROUP BY nb"),
        ("area_revenue",
         "SELECT g.lga_name, r.listing_neighbourhood, a.population_under_20, a.population_under_35, a.rate_20_34, r.estimate_revenue "
         "FROM nb_revenue r JOIN dim_lga g ON lower(g.suburb_name) = lower(r.listing_neighbourhood) JOIN age_profile a ON a.lga_code = g.lga_code"),
        # hosts by how many room kinds they offer (questions 3 and 4)
        ("kinds", "SELECT DISTINCT host_id, property_type, room_type, accommodates FROM listing WHERE has_host AND has_price"),
        ("kind_counts", "SELECT host_id, count(*) AS n_kinds FROM kinds WHERE host_id IS NOT NULL GROUP BY host_id"),
        ("single_host_revenue_sql",
         "SELECT host_id, host_name, nb AS listing_neighbourhood, CAST(sum(revenue) AS BIGINT) AS estimate_revenue "
         "FROM listing SEMI JOIN (FROM kind_counts WHERE n_kinds = 1) USING (host_id) WHERE has_host AND has_price GROUP BY ALL"),
        ("repayments",
         "SELECT CAST(regexp_extract(lga_code_2016, '[0-9]+') AS INTEGER) AS lga_code, "
         "median_mortgage_repay_monthly AS monthly_repay FROM raw_census_two"),
        # rooms of the listing fact per neighbourhood (question 2)
        ("nb_rooms",
         f"SELECT f.listing_neighbourhood, p.property_type, p.room_type, f.accommodates, "
         f"CAST(sum({NIGHTS.format(a='f')} * f.price) AS BIGINT) AS estimate_revenue, "
         f"CAST(sum({NIGHTS.format(a='f')}) AS BIGINT) AS stays "
         "FROM fact_listing f JOIN dim_host h ON h.id = f.listing_id JOIN dim_property p ON p.id = f.listing_id "
         "GROUP BY ALL"),
    ]


def _age_profile_sql() -> str:
    """Persons per age band as rows, added up by the bands each age group is defined by."""
    bands = [f"{b}_m" for b in [*UNDER_20_BANDS, *BANDS_20_34]]
    young = ", ".join(f"'{b}_m'" for b in UNDER_20_BANDS)
    return ("SELECT lga_code, CAST(sum(persons) FILTER (band IN (" + young + ")) AS INTEGER) AS population_under_20, "
            "CAST(sum(persons) AS INTEGER) AS population_under_35, "
            + sql_pct("sum(persons) FILTER (band NOT IN (" + young + "))", "sum(persons)") + " AS rate_20_34 "
            "FROM (UNPIVOT (SELECT CAST(regexp_extract(lga_code_2016, '[0-9]+') AS INTEGER) AS lga_code, " + ", ".join(bands)
            + " FROM raw_census_one) ON " + ", ".join(bands) + " INTO NAME band VALUE persons) GROUP BY lga_code")


def _monthly_sql(keys: str) -> str:
    """Additive monthly parts of every KPI from the rated listing rows."""
    return (
        f"SELECT {keys}, month_year, "
        "count(*) FILTER (WHERE has_availability) AS n_active, "
        "count(has_availability) AS n_flagged, "
        "count(*) FILTER (WHERE NOT has_availability) AS n_inactive, "
        "min(price) FILTER (WHERE has_availability) AS minimum_price, "
        "max(price) FILTER (WHERE has_availability) AS maximum_price, "
        "CAST(quantile_cont(price, 0.5) FILTER (WHERE has_availability) AS DOUBLE) AS median_price, "
        "CAST(sum(price) FILTER (WHERE has_availability) AS BIGINT) AS sum_active_price, "
        "count(price) FILTER (WHERE has_availability) AS n_active_price, "
        "count(DISTINCT host_id) AS distinct_host, "
        "count(*) FILTER (WHERE host_is_superhost) AS n_superhost, "
        "count(host_is_superhost) AS n_superhost_flagged, "
        "CAST(sum(review_scores_rating) FILTER (WHERE has_availability) AS BIGINT) AS sum_active_rating, "
        "count(review_scores_rating) FILTER (WHERE has_availability) AS n_active_rating, "
        "CAST(sum(nights) AS BIGINT) AS stays, "
        "CAST(sum(CASE WHEN has_availability THEN nights * price ELSE 0 END) AS BIGINT) AS sum_revenue_or_zero, "
        "count(CASE WHEN has_availability THEN nights * price ELSE 0 END) AS n_revenue_or_zero "
        "FROM rated_rows GROUP BY ALL")


def _with(final: str) -> str:
    ctes = fixtures.fixture_ctes() + model_ctes()
    if final.lstrip().upper().startswith("WITH"):
        final = f"SELECT * FROM ({final}) q"
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + final


def _kpi_mart(monthly: str, keys: list[str], time_order: bool = False) -> str:
    """The KPI mart from its monthly parts; the change columns look one
    month ahead within the keys, in label or time order."""
    order = "substr(month_year, 4, 4) || substr(month_year, 1, 2)" if time_order else "month_year"
    k = ", ".join(keys)
    cols = [k, "month_year",
            sql_pct("n_active", "n_flagged") + " AS active_listings_ratio",
            "minimum_price", "maximum_price", "median_price",
            sql_ratio("sum_active_price", "n_active_price") + " AS average_price",
            "distinct_host",
            sql_pct("n_superhost", "n_superhost_flagged") + " AS superhost_ratio",
            sql_ratio("sum_active_rating", "n_active_rating") + " AS average_review_scores_rating",
            sql_pct("lead(n_active) OVER ahead - n_active", "n_active") + " AS active_change",
            sql_pct("lead(n_inactive) OVER ahead - n_inactive", "n_active") + " AS inactive_change",
            "stays",
            sql_ratio("sum_revenue_or_zero", "n_revenue_or_zero") + " AS avg_estimate_revenue"]
    return (f"SELECT {', '.join(cols)} FROM {monthly} "
            f"WINDOW ahead AS (PARTITION BY {k} ORDER BY {order})")


def _scd_sql(cols: list[str], key: str, updated_at: str, fmt: str) -> str:
    c = ", ".join(cols)
    return (f"SELECT {c}, md5(concat_ws('|', CAST({key} AS VARCHAR), {updated_at})) AS scd_id, "
            f"{updated_at} AS updated_at, {updated_at} AS valid_from, "
            f"LEAD({updated_at}) OVER (PARTITION BY {key} ORDER BY {_date(updated_at, fmt)} ASC NULLS FIRST, "
            f"{updated_at} ASC NULLS FIRST) AS valid_to "
            f"FROM (SELECT {c} FROM raw_house QUALIFY row_number() OVER "
            f"(PARTITION BY {key}, {_date(updated_at, fmt)} ORDER BY id) = 1) d")


NB_KEYS = "listing_neighbourhood, month_year"


def oracle_queries() -> dict[str, str]:
    house_cols = ", ".join(schemas.HOUSE_COLUMNS)
    scores = schemas.REVIEW_SCORES
    union_cols = ", ".join(
        (f"CASE WHEN scraped_date < '1998-01-01' THEN 0 ELSE {c} END AS {c}" if c in scores else c)
        for c in schemas.HOUSE_COLUMNS)
    fill_cols = ", ".join(schemas.HOUSE_FILL)
    q = {
        # staging / warehouse
        "stg_lga_code": "SELECT * FROM stg_lga_code",
        "stg_lga_suburb": "SELECT * FROM stg_lga_suburb",
        "stg_host": "SELECT * FROM stg_host",
        "stg_listing": "SELECT * FROM stg_listing",
        "stg_property": "SELECT * FROM stg_property",
        "dim_host": "SELECT * FROM dim_host",
        "dim_listing": "SELECT * FROM dim_listing",
        "dim_property": "SELECT * FROM dim_property",
        "dim_lga": "SELECT * FROM dim_lga",
        "fact_one": "SELECT * FROM fact_one",
        "fact_two": "SELECT * FROM fact_two",
        "fact_review": "SELECT * FROM fact_review",
        "fact_listing": "SELECT * FROM fact_listing",
        # marts
        "dm_host_neighbourhood": (
            "SELECT g.lga_name AS host_neighbourhood_lga, s.month_year, count(DISTINCT s.host_id) AS distinct_host, "
            "CAST(sum(s.nights * s.price) AS BIGINT) AS estimate_revenue, "
            + sql_ratio("sum(s.nights * s.price)", "count(DISTINCT s.host_id)") + " AS per_host_estimate_revenue "
            "FROM stay_rows s JOIN dim_lga g ON lower(g.suburb_name) = lower(s.host_neighbourhood) GROUP BY 1, 2"),
        "dm_listing_neighbourhood": _kpi_mart("monthly_nb", ["listing_neighbourhood"]),
        "dm_listing_neighbourhood_time": _kpi_mart("monthly_nb", ["listing_neighbourhood"], True),
        "dm_property_type": _kpi_mart("monthly_kind", ["property_type", "room_type", "accommodates"]),
        # questions
        "q1_best_worst": (
            "SELECT lga_name, listing_neighbourhood, population_under_20, population_under_35, rate_20_34, "
            "estimate_revenue FROM (SELECT *, "
            "row_number() OVER (ORDER BY estimate_revenue DESC NULLS LAST, population_under_35 DESC NULLS LAST, "
            "lga_name ASC NULLS LAST, listing_neighbourhood ASC NULLS LAST) AS from_top, "
            "row_number() OVER (ORDER BY estimate_revenue ASC NULLS FIRST, population_under_35 ASC NULLS FIRST, "
            "lga_name DESC NULLS FIRST, listing_neighbourhood DESC NULLS FIRST) AS from_bottom "
            "FROM area_revenue) t WHERE from_top = 1 OR from_bottom = 1"),
        "q2_best_type": (
            "SELECT listing_neighbourhood, property_type, room_type, accommodates, stays FROM ("
            "SELECT *, dense_rank() OVER (ORDER BY nb_total DESC NULLS LAST, listing_neighbourhood ASC NULLS LAST) AS nb_rank, "
            "row_number() OVER (PARTITION BY listing_neighbourhood ORDER BY stays DESC NULLS LAST, "
            "property_type ASC NULLS LAST, room_type ASC NULLS LAST, accommodates ASC NULLS LAST) AS room_rank "
            "FROM (SELECT *, sum(estimate_revenue) OVER (PARTITION BY listing_neighbourhood) AS nb_total FROM nb_rooms) r"
            ") t WHERE nb_rank <= 5 AND room_rank = 1 AND listing_neighbourhood IS NOT NULL"),
        "q3_local_rate": (
            "SELECT hg.lga_name AS host_lga, count(*) AS total_listings, "
            "count(*) FILTER (WHERE hg.lga_name = lg.lga_name) AS local_listings, "
            + sql_pct("count(*) FILTER (WHERE hg.lga_name = lg.lga_name)", "count(*)") + " AS local_rate "
            "FROM (SELECT home, nb FROM listing SEMI JOIN (FROM kind_counts WHERE n_kinds > 1) USING (host_id) WHERE has_host) h "
            "JOIN dim_lga hg ON lower(hg.suburb_name) = lower(h.home) JOIN dim_lga lg ON lower(lg.suburb_name) = lower(h.nb) GROUP BY hg.lga_name"),
        "q4_mortgage_cover": (
            "SELECT " + sql_ratio("count(*) FILTER (WHERE s.estimate_revenue > r.monthly_repay * 12)", "count(*)")
            + " AS covered FROM single_host_revenue_sql s "
            "JOIN dim_lga g ON lower(g.suburb_name) = lower(s.listing_neighbourhood) "
            "JOIN repayments r ON r.lga_code = g.lga_code"),
        # building blocks
        "neighbourhood_revenue": "SELECT * FROM nb_revenue",
        "age_bands": "SELECT * FROM age_profile",
        "lga_population": "SELECT g.lga_code, g.lga_name, g.suburb_name, a.population_under_20, "
                          "a.population_under_35, a.rate_20_34 FROM dim_lga g JOIN age_profile a ON a.lga_code = g.lga_code",
        "total_rows": "SELECT *, count(*) OVER () AS total_rows FROM area_revenue",
        "top5_neighbourhoods": (
            "SELECT listing_neighbourhood, CAST(sum(estimate_revenue) AS BIGINT) AS estimate_revenue FROM nb_rooms "
            "GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS LAST LIMIT 5"),
        "top1_per_group": (
            "SELECT listing_neighbourhood, property_type, room_type, accommodates, stays FROM nb_rooms "
            "QUALIFY row_number() OVER (PARTITION BY listing_neighbourhood ORDER BY stays DESC NULLS LAST, "
            "property_type ASC NULLS LAST, room_type ASC NULLS LAST, accommodates ASC NULLS LAST) = 1"),
        "host_room_types": "SELECT * FROM kinds",
        "hosts_multi": "SELECT host_id FROM kind_counts WHERE n_kinds > 1",
        "hosts_single": "SELECT host_id FROM kind_counts WHERE n_kinds = 1",
        "single_host_revenue": "SELECT * FROM single_host_revenue_sql",
        "lga_code_parse": "SELECT * FROM repayments",
        "assemble3": ("SELECT l.id, l.listing_id, l.scraped_date, l.listing_neighbourhood, h.host_id, h.host_name, "
                      "h.host_since, h.host_is_superhost, h.host_neighbourhood, p.property_type, p.room_type, "
                      "p.accommodates, p.price, p.has_availability, p.availability_30 "
                      "FROM dim_listing l JOIN dim_host h ON h.id = l.id JOIN dim_property p ON p.id = l.id"),
        "assemble4": ("SELECT l.id, l.listing_id, l.scraped_date, l.listing_neighbourhood, h.host_id, h.host_name, "
                      "h.host_since, h.host_is_superhost, h.host_neighbourhood, p.property_type, p.room_type, "
                      "p.accommodates, p.price, p.has_availability, p.availability_30, r.number_of_reviews, "
                      + ", ".join(f"r.{c}" for c in scores) +
                      " FROM dim_listing l JOIN dim_host h ON h.id = l.id JOIN dim_property p ON p.id = l.id "
                      "JOIN fact_review r ON r.id = l.id"),
        "suburb_join": ("SELECT h.id, h.host_id, g.lga_code, g.lga_name, g.suburb_name FROM dim_host h "
                        "JOIN dim_lga g ON lower(g.suburb_name) = lower(h.host_neighbourhood)"),
        "semi_multi_hosts": ("SELECT id, host_id FROM dim_host h WHERE EXISTS "
                             "(SELECT 1 FROM kind_counts k WHERE k.host_id = h.host_id AND k.n_kinds > 1)"),
        # monthly KPI columns one by one
        "active_ratio": f"SELECT {NB_KEYS}, " + sql_pct("n_active", "n_flagged") + " AS active_listings_ratio FROM monthly_nb",
        "superhost_ratio": f"SELECT {NB_KEYS}, " + sql_pct("n_superhost", "n_superhost_flagged")
                           + " AS superhost_ratio FROM monthly_nb",
        "active_price_stats": f"SELECT {NB_KEYS}, minimum_price, maximum_price, "
                              + sql_ratio("sum_active_price", "n_active_price") + " AS average_price FROM monthly_nb",
        "median_price": f"SELECT {NB_KEYS}, median_price FROM monthly_nb",
        "distinct_hosts": f"SELECT {NB_KEYS}, distinct_host FROM monthly_nb",
        "stays": f"SELECT {NB_KEYS}, stays FROM monthly_nb",
        "avg_estimate_revenue": f"SELECT {NB_KEYS}, " + sql_ratio("sum_revenue_or_zero", "n_revenue_or_zero")
                                + " AS avg_estimate_revenue FROM monthly_nb",
        "revenue_per_host": (
            "SELECT g.lga_name AS host_neighbourhood_lga, s.month_year, "
            + sql_ratio("sum(s.nights * s.price)", "count(DISTINCT s.host_id)") + " AS per_host_estimate_revenue "
            "FROM stay_rows s JOIN dim_lga g ON lower(g.suburb_name) = lower(s.host_neighbourhood) GROUP BY 1, 2"),
        "running_active": f"SELECT {NB_KEYS}, n_active, CAST(sum(n_active) OVER (PARTITION BY listing_neighbourhood "
                          "ORDER BY month_year) AS BIGINT) AS running_active FROM monthly_nb",
        "lead_active": f"SELECT {NB_KEYS}, n_active, lead(n_active) OVER (PARTITION BY listing_neighbourhood "
                       "ORDER BY month_year) AS next_active FROM monthly_nb",
        "active_change": f"SELECT {NB_KEYS}, " + sql_pct("lead(n_active) OVER ahead - n_active", "n_active")
                         + " AS active_change FROM monthly_nb WINDOW ahead AS "
                           "(PARTITION BY listing_neighbourhood ORDER BY month_year)",
        "active_change_time": f"SELECT {NB_KEYS}, " + sql_pct("lead(n_active) OVER ahead - n_active", "n_active")
                              + " AS active_change FROM monthly_nb WINDOW ahead AS (PARTITION BY listing_neighbourhood "
                                "ORDER BY substr(month_year, 4, 4) || substr(month_year, 1, 2))",
        "inactive_change": f"SELECT {NB_KEYS}, " + sql_pct("lead(n_inactive) OVER ahead - n_inactive", "n_active")
                           + " AS inactive_change FROM monthly_nb WINDOW ahead AS "
                             "(PARTITION BY listing_neighbourhood ORDER BY month_year)",
        "month_label": "SELECT strftime(scraped_date, '%m/%Y') AS month_year, count(*) AS n_rows FROM dim_listing GROUP BY 1",
        "round_exact": ("SELECT property_type, " + sql_ratio("sum(price)", "count(price)") + " AS average_price, "
                        + sql_pct("count(*) FILTER (WHERE has_availability)", "count(*)")
                        + " AS active_pct FROM dim_property GROUP BY property_type"),
        # history on natural keys
        "scd2_host": _scd_sql(HOST_COLS, "host_id", "host_since", HOST_FMT),
        "scd2_listing": _scd_sql(LISTING_COLS, "listing_id", "scraped_date", SCRAPE_FMT),
        "scd2_property": _scd_sql(["id", "listing_id"] + PROPERTY_COLS[1:], "listing_id", "scraped_date", SCRAPE_FMT),
        "scd2_review": _scd_sql(["id", "listing_id"] + REVIEW_COLS[1:], "listing_id", "scraped_date", SCRAPE_FMT),
        # loading
        "fill_defaults": f"SELECT id, {fill_cols} FROM raw_house",
        "project_columns": f"SELECT {house_cols} FROM raw_house",
        "coerce_types": "SELECT * FROM raw_census_two",
        "surrogate_id": ("SELECT l_orderkey, l_linenumber, (l_orderkey * 8 + l_linenumber) * 64 + row_number() OVER "
                         "(PARTITION BY l_orderkey, l_linenumber ORDER BY "
                         + ", ".join(f"{c} ASC NULLS LAST" for c in fixtures.LINEITEM_ORDER) + ") AS id FROM lineitem"),
        "check_unique": "SELECT lga_code, COUNT(*) AS n_rows FROM dim_lga GROUP BY lga_code HAVING COUNT(*) > 1",
        "union_months": f"SELECT id, {union_cols} FROM raw_house",
        # sources and sinks
        "src_lga_code": "SELECT lga_code, lga_name FROM raw_lga_code",
        "src_lga_suburb": "SELECT lga_name, suburb_name FROM raw_lga_suburb",
        "src_census_two": "SELECT * EXCLUDE (id) FROM raw_census_two",
        "src_census_one": "SELECT * EXCLUDE (id) FROM raw_census_one",
        "src_house": f"SELECT id, {house_cols} FROM raw_house",
        "sink_roundtrip": f"SELECT id, {house_cols} FROM raw_house",
        "catalog_months": f"SELECT id, {house_cols} FROM raw_house",
        "catalog_pruned": f"SELECT id, {house_cols} FROM raw_house WHERE substr(scraped_date, 1, 7) IN ('1995-03', '1997-11')",
        "load_rejects": (
            "SELECT id, 'price' AS \"column\", 'n/a' AS text FROM raw_house WHERE id % 97 = 0 "
            "UNION ALL SELECT id, 'has_availability', 'maybe' FROM raw_house WHERE id % 83 = 0 "
            "UNION ALL SELECT id, 'accommodates', '99999999999' FROM raw_house WHERE id % 73 = 0"),
        "load_checked": (
            "SELECT id, CASE WHEN id % 79 = 0 THEN 100000000000000000 + listing_id % 1000 ELSE listing_id END AS listing_id, "
            "CASE WHEN id % 73 = 0 THEN NULL ELSE accommodates END AS accommodates, "
            "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN price + 1 ELSE price END AS price, "
            "CASE WHEN id % 83 = 0 THEN NULL ELSE has_availability END AS has_availability FROM raw_house"),
        "serial_ids": (
            "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY CASE WHEN l_shipdate < DATE '1995-06-01' THEN 0 ELSE 1 END, "
            "l_orderkey NULLS LAST, l_linenumber NULLS LAST, " + ", ".join(f"{c} NULLS LAST" for c in fixtures.LINEITEM_ORDER)
            + ") AS id FROM lineitem WHERE l_shipdate IS NOT NULL"),
        # persisted snapshot runs: the same history as in one go; hosts live where their latest listing is
        "snapshot_host": _scd_sql([*HOST_COLS, "scraped_date"], "host_id", "scraped_date", SCRAPE_FMT).replace(
            "FROM raw_house", "FROM (SELECT * REPLACE (listing_neighbourhood AS host_neighbourhood) FROM raw_house)"),
        "snapshot_listing": _scd_sql(LISTING_COLS, "listing_id", "scraped_date", SCRAPE_FMT),
        "snapshot_property": _scd_sql(["id", "listing_id"] + PROPERTY_COLS[1:], "listing_id", "scraped_date", SCRAPE_FMT),
        "snapshot_review": _scd_sql(["id", "listing_id"] + REVIEW_COLS[1:], "listing_id", "scraped_date", SCRAPE_FMT),
        # streaming ingestion: the same history and rows as in one load
        "stream_ingest": _scd_sql(LISTING_COLS, "listing_id", "scraped_date", SCRAPE_FMT),
        "stream_raw": f"SELECT id, {house_cols} FROM raw_house",
    }
    q |= {"median_selected": q["median_price"], "incremental_mart": q["dm_listing_neighbourhood"], "suburb_join_salted": q["suburb_join"],
          "distinct_hosts_merged": "SELECT listing_neighbourhood, count(DISTINCT host_id) AS distinct_host, TRUE AS within_error "
                                   "FROM rated_rows WHERE listing_neighbourhood IS NOT NULL GROUP BY listing_neighbourhood"}
    q |= {f"stream_{n}": q[f"snapshot_{n}"] for n in ("listing", "property", "review")}
    q |= {"stream_host": _scd_sql([*HOST_COLS, "scraped_date"], "host_id", "scraped_date", SCRAPE_FMT)}
    q |= {"assemble3_stored": q["assemble3"], "assemble4_stored": q["assemble4"]}
    return {name: _with(sql) for name, sql in q.items()}
