"""Staging and warehouse models over the five raw tables.

The host, listing, property and review histories are vertical slices of the
one listings table, keyed by its row id. Because that id is unique (it is
built that way on load), re-assembling slices with ``JOIN .. ON id`` is the
same as reading the table once and applying every slice's filter:
``Warehouse.rows`` does that, so no mart or question shuffles the listings
to join them back to themselves. ``operators.assemble`` is the join form for
slices that are stored separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions.dates import HOST_SINCE_FORMAT, SCRAPED_DATE_FORMAT, parse_date
from staylake.operators.history import scd2_bulk
from staylake.operators.joins import bounded_broadcast, fold_join
from staylake.sources import fixtures, schemas
from staylake.sources.catalog import read_raw_tables
from staylake.sources.store import materialize

HOST_COLUMNS = ["id", "host_id", "host_name", "host_since", "host_is_superhost", "host_neighbourhood"]
LISTING_COLUMNS = ["id", "listing_id", "scraped_date", "listing_neighbourhood"]
PROPERTY_COLUMNS = ["id", "scraped_date", "property_type", "room_type", "accommodates",
                    "price", "has_availability", "availability_30"]
REVIEW_COLUMNS = ["id", "scraped_date", "number_of_reviews", *schemas.REVIEW_SCORES]


def _host_date(c) -> Column:
    return parse_date(c, HOST_SINCE_FORMAT)


def _scrape_date(c) -> Column:
    return parse_date(c, SCRAPED_DATE_FORMAT)


# Each slice: its staged columns (as expressions over the raw row) and the
# staging filter. Staging reads a history table; these expressions read the
# same columns from it.
def _host_staged() -> dict[str, Column]:
    return {
        "id": F.col("id"), "host_id": F.col("host_id"), "host_name": F.col("host_name"),
        "host_since": _host_date("host_since"),
        "host_is_superhost": F.col("host_is_superhost"),
        "host_neighbourhood": F.lower("host_neighbourhood"),
    }


def _host_filter() -> Column:
    return (F.col("host_name") != "") & (F.col("host_since") != "")


def _listing_staged() -> dict[str, Column]:
    return {
        "id": F.col("id"), "listing_id": F.col("listing_id"),
        "scraped_date": _scrape_date("scraped_date"),
        "listing_neighbourhood": F.lower("listing_neighbourhood"),
    }


def _property_staged() -> dict[str, Column]:
    return {
        "id": F.col("id"), "scraped_date": _scrape_date("scraped_date"),
        **{c: F.col(c) for c in PROPERTY_COLUMNS[2:]},
    }


def _property_filter() -> Column:
    return F.col("price") > 5


def _review_staged() -> dict[str, Column]:
    return {c: F.col(c) for c in REVIEW_COLUMNS}


class Warehouse:
    """The star schema over one set of raw tables. Models are lazy DataFrames, but for the row count
    that decides whether the LGA lookup is broadcast. ``history``: a ``SnapshotStore`` whose slices
    (``row_slices``) the staging models read instead of building them from the raw table."""

    def __init__(self, raw: dict[str, DataFrame], broadcast_rows: int | None = None, history=None):
        self.raw = raw
        self.history = history
        self._broadcast_rows = broadcast_rows
        self._lga_lookup: DataFrame | None = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, materialized: bool = False,
                      **kw) -> "Warehouse":
        """Raw tables derived from the test tables; ``materialized`` writes
        them once to the shared folder (the load stage) and reads them back."""
        raw = fixtures.raw_tables(spark, sf_dir)
        if materialized:
            raw = materialize(spark, raw)
        return cls(raw, **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "raw", **kw) -> "Warehouse":
        """The raw tables by their logical names (see ``sources.catalog``)."""
        return cls(read_raw_tables(spark, database), **kw)

    MODELS = ("stg_lga_code", "stg_lga_suburb", "stg_host", "stg_listing", "stg_property",
              "dim_host", "dim_listing", "dim_property", "dim_lga", "fact_one", "fact_two",
              "fact_review", "fact_listing")

    def register_views(self) -> list[str]:
        """Every model as a temporary view of its plan, so models can be read by
        name from SQL; only the LGA lookup is counted here."""
        for name in self.MODELS:
            getattr(self, name)().createOrReplaceTempView(name)
        return list(self.MODELS)

    @property
    def house(self) -> DataFrame:
        return self.raw["house"]

    # ---- history (H3-H6): the listings table is keyed by its unique row id
    def _snapshot(self, name: str, columns: list[str], updated_at: str) -> DataFrame:
        kept = self.history.read(name) if self.history is not None else None
        return kept if kept is not None else scd2_bulk(self.house.select(*columns), "id", updated_at, unique_key=True)

    def host_snapshot(self) -> DataFrame:
        return self._snapshot("host", HOST_COLUMNS, "host_since")

    def listing_snapshot(self) -> DataFrame:
        return self._snapshot("listing", LISTING_COLUMNS, "scraped_date")

    def property_snapshot(self) -> DataFrame:
        return self._snapshot("property", PROPERTY_COLUMNS, "scraped_date")

    def review_snapshot(self) -> DataFrame:
        return self._snapshot("review", REVIEW_COLUMNS, "scraped_date")

    # ---- staging (M1-M5)
    def stg_lga_code(self) -> DataFrame:
        return self.raw["nsw_lga_code"].select("lga_code", F.lower("lga_name").alias("lga_name"))

    def stg_lga_suburb(self) -> DataFrame:
        return self.raw["nsw_lga_suburb"].select(F.lower("lga_name").alias("lga_name"),
                                                 F.lower("suburb_name").alias("suburb_name"))

    def stg_host(self) -> DataFrame:
        s = self.host_snapshot().filter(_host_filter())
        staged = _host_staged()
        return s.select(*[v.alias(k) for k, v in staged.items()], "scd_id",
                        _host_date("updated_at").alias("updated_at"),
                        _host_date("valid_from").alias("valid_from"), "valid_to")

    def stg_listing(self) -> DataFrame:
        s = self.listing_snapshot()
        return s.select(*[v.alias(k) for k, v in _listing_staged().items()],
                        _scrape_date("updated_at").alias("updated_at"),
                        _scrape_date("valid_from").alias("valid_from"), "valid_to")

    def stg_property(self) -> DataFrame:
        s = self.property_snapshot().filter(_property_filter())
        return s.select(*[v.alias(k) for k, v in _property_staged().items()],
                        _scrape_date("updated_at").alias("updated_at"),
                        _scrape_date("valid_from").alias("valid_from"), "valid_to")

    # ---- warehouse (M6-M13)
    dim_host = stg_host
    dim_listing = stg_listing
    dim_property = stg_property

    def fact_review(self) -> DataFrame:
        return self.review_snapshot()

    def fact_one(self) -> DataFrame:
        return self.raw["census_one"]

    def fact_two(self) -> DataFrame:
        return self.raw["census_two"]

    def dim_lga(self) -> DataFrame:
        """One row per (LGA, suburb): a suburb listed under two LGAs appears twice."""
        return (self.stg_lga_code().join(self.stg_lga_suburb(), "lga_name")
                .select("lga_code", "lga_name", "suburb_name"))

    def lga_lookup(self) -> DataFrame:
        """``dim_lga`` marked for broadcast once its row count is checked."""
        if self._lga_lookup is None:
            kw = {"max_rows": self._broadcast_rows} if self._broadcast_rows else {}
            self._lga_lookup = bounded_broadcast(self.dim_lga(), **kw)
        return self._lga_lookup

    # ---- re-assembled listing rows
    def rows(self, host: bool = False, listing: bool = True, property: bool = False,
             review: bool = False, kind: bool = False) -> DataFrame:
        """``listing JOIN host JOIN property JOIN review ON id`` for the chosen
        slices, as one filtered scan of the listings table (row id is unique).
        ``kind`` adds the room kind of rows that the property slice keeps, NULL
        on the others, without filtering them."""
        staged: dict[str, Column] = {}
        cond = F.lit(True)
        if listing:
            staged.update(_listing_staged())
        if host:
            staged.update({k: v for k, v in _host_staged().items() if k not in staged})
            cond = cond & _host_filter()
        if property:
            staged.update({k: v for k, v in _property_staged().items() if k not in staged})
            cond = cond & _property_filter()
        if review:
            staged.update({k: v for k, v in _review_staged().items() if k not in staged})
        if kind:
            staged["kind"] = F.when(_property_filter(), F.struct("property_type", "room_type", "accommodates"))
        return self.house.filter(cond).select(*[v.alias(k) for k, v in staged.items()])

    def fact_listing(self) -> DataFrame:
        """Wide listing fact; review measures come from the review history (the
        property slice has none). The LGA lookup is a left join on suburb, so a
        suburb in two LGAs yields two rows."""
        r = self.rows(host=True, listing=True, property=True, review=True)
        joined = fold_join(r, self.lga_lookup(), "listing_neighbourhood", "suburb_name", "left")
        return joined.select(
            F.col("id").alias("listing_id"),
            F.col("listing_id").alias("original_listing_id"),
            "scraped_date", "host_id", "host_name", "host_neighbourhood",
            "listing_neighbourhood", "property_type", "room_type", "accommodates",
            "price", "has_availability", "availability_30", "number_of_reviews",
            "review_scores_rating",
            F.col("lga_name").alias("listing_neighbourhood_lga"),
            F.col("suburb_name").alias("listing_suburb"))

