"""Loading raw feeds: distributed CSV scan, gap filling, type coercion,
surrogate keys and the union of monthly files.

Every step is a DataFrame transformation; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.functions.dates import parse_date
from staylake.operators.quality import check_unique
from staylake.session import scratch_path
from staylake.sources import schemas


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Reading options of every feed, batch or stream: quotes are doubled inside quoted text, headers
    are checked against the schema, and every row is parsed in full so that a malformed one fails.

    ``multi_line`` admits line breaks inside quoted text; a file is then read by one task."""
    return {"header": "true", "enforceSchema": "false", "mode": "FAILFAST", "escape": '"',
            "columnPruning": "false", "multiLine": str(multi_line).lower()}


def read_feed_csv(spark: SparkSession, name: str, paths: str | Sequence[str],
                  base_path: str | None = None, with_id: bool = False, multi_line: bool = False,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Schema'd CSV scan of one feed (no inference).

    Header names are checked against the declared schema (case-insensitive),
    so a feed whose columns moved fails instead of loading shifted data.
    ``paths`` may be a list of monthly files: one distributed scan.
    ``columns`` gives the files' own column order; unknown columns are text.
    """
    schema, _ = schemas.FEEDS[name]
    if with_id:
        schema = T.StructType([T.StructField("id", T.LongType())] + schema.fields)
    if columns is not None:
        known = {f.name: f for f in schema.fields}
        schema = T.StructType([known.get(c.lower(), T.StructField(c, T.StringType())) for c in columns])
    reader = spark.read.schema(schema).options(**csv_options(multi_line))
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_months_csv(spark: SparkSession, name: str, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Monthly files aligned by column name: files with one header are scanned together, and the
    scans are united by name; a column that a month lacks is NULL there, one that the feed does
    not declare is dropped. Only the header lines are read on the driver."""
    declared = [f.name for f in schemas.FEEDS[name][0].fields]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(spark.read.option("header", True).option("escape", '"').csv(path).columns)
        by_header.setdefault(header, []).append(path)
    frames = []
    for header, files in by_header.items():
        df = read_feed_csv(spark, name, files, multi_line=multi_line, columns=header)
        present = {c.lower() for c in header}
        frames.append(df.select(*[c for c in declared if c in present]))
    whole = union_months(frames)
    types = {f.name: f.dataType for f in schemas.FEEDS[name][0].fields}
    return whole.select(*[F.col(c) if c in whole.columns else F.lit(None).cast(types[c]).alias(c) for c in declared])


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill gaps with typed defaults (text, boolean and numeric in one pass).

    ``DataFrame.fillna`` skips values whose type does not match the column,
    so booleans and strings are filled with ``coalesce`` explicitly.
    """
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType))
        for name, value in present.items()
    })


def _coerce(c: Column, source_type: str, target: str, round_numbers: bool) -> Column:
    if target in ("int", "bigint", "smallint"):
        if source_type in ("double", "float", "decimal") and round_numbers:
            # Numeric insert into an integer column rounds half away from zero.
            c = F.round(c)
        elif source_type == "string":
            c = c.try_cast("decimal(38,10)")  # keeps every digit of a bigint
            c = F.round(c) if round_numbers else c
        return c.try_cast(target)
    if target == "boolean":
        return c.try_cast("boolean") if source_type != "boolean" else c
    return c.try_cast(target) if source_type != target else c


def _simple_type(df: DataFrame, name: str) -> str:
    t = df.schema[name].dataType.simpleString()
    return "decimal" if t.startswith("decimal") else t


def coerce_types(df: DataFrame, types: dict[str, str], round_numbers: bool = True) -> DataFrame:
    """Cast columns to the declared table types.

    Numbers going into integer columns are rounded (not truncated, which is
    what a bare Spark cast does); malformed values become NULL rather than
    failing the load; ``coercion_rejects`` counts them.
    """
    return df.withColumns({
        name: _coerce(F.col(name), _simple_type(df, name), target, round_numbers)
        for name, target in types.items() if name in df.columns
    })


def coercion_rejects(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row: per column, how many non-NULL input values failed coercion."""
    checks = []
    for name, target in types.items():
        if name in raw.columns:
            new = _coerce(F.col(name), _simple_type(raw, name), target, True)
            bad = F.col(name).isNotNull() & new.isNull()
            checks.append(F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias(name))
    return raw.agg(*checks)


REJECTS = "_rejects"


def with_rejects(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Adds ``_rejects``: the columns whose value does not fit the declared type, with the text it came as."""
    found = []
    for name, target in types.items():
        if name in df.columns:
            new = _coerce(F.col(name), _simple_type(df, name), target, True)
            found.append(F.when(F.col(name).isNotNull() & new.isNull(),
                                F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("text"))))
    none = F.array().cast("array<struct<column:string,text:string>>")
    return df.withColumn(REJECTS, F.filter(F.array(*found), lambda x: x.isNotNull()) if found else none)


@dataclass(frozen=True)
class Loaded:
    """A written table, its rejected values (``key`` columns, column, text), and how many each column has."""

    table: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def write_checked(df: DataFrame, path: str, types: dict[str, str], key: Sequence[str] = ("id",), unique: bool = True) -> Loaded:
    """Write typed rows that carry ``_rejects`` and count the rejected values in the same pass.

    The values that did not fit stay next to their row in the written files, so
    the side table needs no second look at the feed; the counts are metrics of the write. ``unique``
    checks that no two rows have the same ``key`` (on the written key columns only)."""
    spark, seen = df.sparkSession, Observation()
    per_column = [F.coalesce(F.sum(F.size(F.filter(REJECTS, lambda x: x["column"] == name))), F.lit(0)).alias(name) for name in types]
    df.observe(seen, F.count(F.lit(1)).alias("rows_written"), *per_column).write.mode("overwrite").parquet(path)
    counts = {k: int(v) for k, v in seen.get.items()}
    written = spark.read.schema(df.schema).parquet(path)
    if unique:
        double = check_unique(written, list(key)).limit(5).collect()
        if double:
            raise ValueError(f"rows share a key ({', '.join(key)}): {[tuple(r) for r in double]}")
    rejects = written.filter(F.size(REJECTS) > 0).select(*key, F.inline(REJECTS))
    return Loaded(written.drop(REJECTS), rejects, counts)


def serial_ids(df: DataFrame, stored: DataFrame | None = None, name: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """Ids for a further load: 1, 2, 3, .. from the largest id in ``stored``, in the order of the rows (or of
    ``order``). Ids given before stay as they are.

    The load is written once with each row's place; counts per write task, a row each, are added up to
    offsets, so nothing is gathered and a re-read gives the same ids. Check uniqueness when
    the load is stored (``write_checked``): two loads numbered at the same time would collide."""
    spark = df.sparkSession
    if order:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    path = scratch_path(spark, "serial-ids")
    df.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_place", T.LongType())])).parquet(path)
    task = F.shiftright("_place", 33)
    first = 0 if stored is None else stored.agg(F.max(name)).first()[0] or 0
    before = F.sum("_rows").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows")).select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    number = F.lit(first + 1) + F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), task == F.col("_task")).withColumn(name, number).drop("_place", "_task", "_before")


def surrogate_id(df: DataFrame, base: Column, partition: Sequence[str],
                 order: Sequence[str], copies: int = 64, name: str = "id") -> DataFrame:
    """Deterministic distributed row key: ``base * copies + row_number``.

    ``base`` must be an integral expression unique per ``partition`` value, or
    NULL where it does not fit; the row number tells apart the rows sharing a
    natural key, ordered by ``order``. Rows beyond ``copies`` and rows without
    a base get a negative id, the hash of their natural key and number, so no
    count or value of a key stops a load (``check_unique`` proves a loaded
    table). Unlike load order or ``monotonically_increasing_id``, the result
    does not depend on how the files were split, so a re-run or a lost executor
    reproduces the same ids.
    """
    w = Window.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    df = df.withColumn("_copy", F.row_number().over(w))
    rn = F.col("_copy")
    hashed = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in partition], rn)
    beyond = -F.lit((1 << 63) - 1).bitwiseAND(hashed) - 1
    rid = F.when(base.isNotNull() & (rn <= copies), base.cast("bigint") * F.lit(copies) + rn).otherwise(beyond)
    return df.withColumn(name, rid.cast("bigint")).drop("_copy")


def union_months(frames: Iterable[DataFrame]) -> DataFrame:
    """Union feeds by column name; a column missing from one feed is NULL there."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pick and order the target table's columns by name."""
    return df.select(*columns)


def load_feed(spark: SparkSession, name: str, paths: str | Sequence[str],
              base_path: str | None = None, with_id: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV feed to a typed raw table: scan, fill gaps, coerce types.

    ``with_id`` reads a leading ``id`` column that the file already carries
    (otherwise assign one with ``surrogate_id``).
    """
    keep = ["id"] if with_id else []
    return typed(read_feed_csv(spark, name, paths, base_path, with_id, multi_line), name, keep)


def typed(df: DataFrame, name: str, keep: Sequence[str] = (), rejects: bool = False) -> DataFrame:
    """A feed's rows with the table's types and filled gaps; ``rejects`` keeps the values that did not fit."""
    _, types = schemas.FEEDS[name]
    if rejects:
        df, keep = with_rejects(df, types), [*keep, REJECTS]
    df = coerce_types(df, types)
    if name == "house":
        df = fill_defaults(df, schemas.HOUSE_FILL)
    return df.select(*keep, *[c for c in types if c in df.columns])


def load_checked(df: DataFrame, name: str, path: str, ids: Callable[[DataFrame], DataFrame] | None = None, key: Sequence[str] = ("id",)) -> Loaded:
    """A feed's rows to a written, typed raw table with its rejects. ``ids`` gives the rows their ids
    (e.g. ``house_ids``); without it the feed must carry the ``key``."""
    rows = typed(df, name, [] if ids else list(key), rejects=True)
    return write_checked(ids(rows) if ids else rows, path, schemas.FEEDS[name][1], key)


# ---- fixed values: feed file names in the source folder layout -------------
FEED_FILES = {
    "nsw_lga_code": "NSW_LGA/NSW_LGA_CODE.csv",
    "nsw_lga_suburb": "NSW_LGA/NSW_LGA_SUBURB.csv",
    "census_two": "Census LGA/2016Census_G02_NSW_LGA.csv",
    "census_one": "Census LGA/2016Census_G01_NSW_LGA.csv",
}
LISTINGS_FOLDER = "listings"
MONTH_SLOTS = 4096          # months since 1970 fit below this for 340 years
MAX_LISTING_ID = 2 ** 44    # larger ids than listing_id * MONTH_SLOTS * 64 can hold are hashed


def house_ids(df: DataFrame) -> DataFrame:
    """Row ids for a listings feed that carries none: the natural key is
    (listing, scrape month); rows sharing it are numbered in a fixed column
    order, so a re-run or a lost task gives the same ids."""
    month = parse_date("scraped_date", "yyyy-MM-dd")
    month_index = (F.year(month) - 1970) * 12 + F.month(month) - 1
    fits = F.when(F.col("listing_id").between(0, MAX_LISTING_ID - 1), F.col("listing_id"))
    df = df.withColumn("_month_index", F.coalesce(month_index, F.lit(MONTH_SLOTS - 1)))
    out = surrogate_id(df, fits * MONTH_SLOTS + F.col("_month_index"),
                       ["listing_id", "_month_index"],
                       [c for c in schemas.HOUSE_COLUMNS if c != "listing_id"])
    return out.drop("_month_index")


def load_feeds(spark: SparkSession, folder: str, months: Sequence[str], multi_line: bool = False) -> dict[str, DataFrame]:
    """The five raw tables from a feed folder: the LGA and census files, and
    the monthly listing files ``listings/<MM_YYYY>.csv`` named in ``months``
    (aligned by column name; months with one header in one distributed scan). LGA-level rows get load-order
    ids (no model reads them); listing rows get ``house_ids``."""
    tables = {}
    for name, rel in FEED_FILES.items():
        df = load_feed(spark, name, f"{folder}/{rel}")
        tables[name] = df.select(F.monotonically_increasing_id().alias("id"), *df.columns)
    house = typed(read_months_csv(spark, "house", [f"{folder}/{LISTINGS_FOLDER}/{m}.csv" for m in months], multi_line), "house")
    tables["house"] = house_ids(house).select("id", *schemas.HOUSE_COLUMNS)
    return tables


def load_feeds_checked(spark: SparkSession, folder: str, months: Sequence[str], base: str, multi_line: bool = False) -> dict[str, Loaded]:
    """``load_feeds`` written under ``base``, with the rejected values of every table and a check
    that ids are unique. LGA-level ids are given once, on writing."""
    out = {}
    for name, rel in FEED_FILES.items():
        feed = read_feed_csv(spark, name, f"{folder}/{rel}", multi_line=multi_line)
        out[name] = load_checked(feed, name, f"{base}/{name}", ids=lambda d: d.withColumn("id", F.monotonically_increasing_id()))
    house = read_months_csv(spark, "house", [f"{folder}/{LISTINGS_FOLDER}/{m}.csv" for m in months], multi_line)
    out["house"] = load_checked(house, "house", f"{base}/house", ids=house_ids)
    return out
