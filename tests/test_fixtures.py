"""The Spark derivation of the five raw tables equals its SQL twin, row by
row: every oracle comparison rests on this."""

import duckdb
import pytest

from staylake.sources import fixtures
from tests.conftest import SMOKE_DIR

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
PAIRS = [("house", "raw_house"), ("nsw_lga_code", "raw_lga_code"), ("nsw_lga_suburb", "raw_lga_suburb"),
         ("census_one", "raw_census_one"), ("census_two", "raw_census_two")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE_DIR}/{t}.parquet'")
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in fixtures.fixture_ctes())
    return con, ctes


@pytest.mark.parametrize("spark_name,sql_name", PAIRS)
def test_raw_table_equals_sql(spark, duck, spark_name, sql_name):
    con, ctes = duck
    df = fixtures.raw_tables(spark, SMOKE_DIR)[spark_name]
    got = sorted(tuple(str(v) for v in r) for r in df.orderBy("id").collect())
    rel = con.sql(f"WITH {ctes} SELECT * FROM {sql_name}")
    assert rel.columns == df.columns
    want = sorted(tuple(str(v) for v in r) for r in rel.fetchall())
    assert got == want
