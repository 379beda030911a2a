"""Hand-written raw tables for unit tests."""


from staylake.plans.warehouse import Warehouse
from staylake.sources import schemas

HOUSE_DDL = ("id bigint, listing_id bigint, scrape_id string, scraped_date string, host_id bigint, "
             "host_name string, host_since string, host_is_superhost boolean, host_neighbourhood string, "
             "listing_neighbourhood string, property_type string, room_type string, accommodates int, "
             "price int, has_availability boolean, availability_30 int, number_of_reviews int, "
             + ", ".join(f"{c} int" for c in schemas.REVIEW_SCORES))

DEFAULT_ROW = {
    "listing_id": 1, "scrape_id": "202101", "scraped_date": "2021-01-15", "host_id": 100,
    "host_name": "ann", "host_since": "01/02/2015", "host_is_superhost": False,
    "host_neighbourhood": "Bondi", "listing_neighbourhood": "Bondi", "property_type": "Apartment",
    "room_type": "Entire home", "accommodates": 2, "price": 100, "has_availability": True,
    "availability_30": 10, "number_of_reviews": 3, **{c: 90 for c in schemas.REVIEW_SCORES},
}


def house(spark, rows):
    cols = [c.split()[0] for c in HOUSE_DDL.split(", ")]
    data = []
    for i, r in enumerate(rows):
        full = {"id": i + 1, **DEFAULT_ROW, **r}
        data.append(tuple(full[c] for c in cols))
    return spark.createDataFrame(data, HOUSE_DDL)


def warehouse(spark, rows, suburbs=None, codes=None, census_two=None, census_one=None):
    codes = codes or [(1, 10001, "Waverley"), (2, 10002, "Sydney")]
    suburbs = suburbs or [(1, "Waverley", "Bondi"), (2, "Sydney", "Surry Hills")]
    lga_code = spark.createDataFrame(codes, "id bigint, lga_code int, lga_name string")
    lga_suburb = spark.createDataFrame(suburbs, "id bigint, lga_name string, suburb_name string")
    two_cols = schemas.census_two_columns()
    census_two = census_two or [(1, "LGA10001", *[100] * len(two_cols)), (2, "LGA10002", *[200] * len(two_cols))]
    c2 = spark.createDataFrame(census_two, "id bigint, lga_code_2016 string, "
                               + ", ".join(f"{c} int" for c in two_cols))
    one_cols = schemas.census_one_columns()
    census_one = census_one or [(1, "LGA10001", *[10] * len(one_cols)), (2, "LGA10002", *[0] * len(one_cols))]
    c1 = spark.createDataFrame(census_one, "id bigint, lga_code_2016 string, "
                               + ", ".join(f"{c} int" for c in one_cols))
    return Warehouse({"house": house(spark, rows), "nsw_lga_code": lga_code, "nsw_lga_suburb": lga_suburb,
                      "census_one": c1, "census_two": c2})


def rows_of(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: [(x is None, str(x)) for x in t])
