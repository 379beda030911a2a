"""Named tables: the ``raw`` namespace with typed, create-if-absent tables, and stored slices.

The database and its tables live under the shared folder (never a
machine-local warehouse directory); ``spark.table("raw.house")`` then reads
a base table by its logical name. Listings are partitioned by scrape month:
saving a month replaces that month only, and a filter on months reads only theirs.
To bound a month's files, rows are not shuffled: they are written once by month and
task, and each month's small files are read again by as many tasks as it may have
files. Stored columns take a fraction of the bytes that shuffled rows take.
"""

from __future__ import annotations

import os
from contextlib import contextmanager
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.session import scratch_path, shared_dir
from staylake.sources import schemas
from staylake.sources.sinks import dealt_by

RAW_DATABASE = "raw"


def table_ddl(types: dict[str, str]) -> str:
    """Column list of a raw table: the surrogate ``id`` then the feed columns."""
    return ", ".join(["id BIGINT"] + [f"{c} {t.upper()}" for c, t in types.items()])


MONTH = "scrape_month"  # partition of the listings: yyyy-MM of the scrape date, NULL where that is missing


MONTHS = 1000  # listings of more months than that at once are shuffled by month
OPEN_FILES = 128  # months that a task writes side by side; rows of further months are sorted first


# a task keeps a file open for each month instead of sorting its rows
SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
# Overwrites replace only the partitions that have incoming rows. The months' reads stay tasks of their own when they
# are united (also with a file each), and their code, which is the same, is compiled once and not once a month.
REPLACING = {"spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.unionOutputPartitioning": "false",
             "spark.sql.codegen.useIdInClassName": "false", **SIDE_BY_SIDE}


@contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def create_raw_tables(spark: SparkSession, database: str = RAW_DATABASE,
                      location: str | None = None) -> str:
    """``CREATE DATABASE / TABLE IF NOT EXISTS`` for the five raw tables
    (Parquet, external, under ``location``). Returns the location."""
    base = location or os.path.join(shared_dir(spark), "staylake", "catalog", database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    for name, (_, types) in schemas.FEEDS.items():
        columns, parts = table_ddl(types), ""
        if name == "house":
            columns, parts = f"{columns}, {MONTH} STRING", f"PARTITIONED BY ({MONTH}) "
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
                  f"USING parquet {parts}LOCATION '{os.path.join(base, name)}'")
    return base


def stored_by_month(df: DataFrame, sort: bool = False) -> DataFrame:
    """Listings written once under the shared folder, a folder per month, by the tasks that hold them, and
    read back with their month, for any number of ``save_raw_tables`` and ``write_months``. ``sort``: tasks sort
    their rows by month, which takes a fraction of the time, where they hold a share that fits in memory."""
    spark = df.sparkSession
    path = scratch_path(spark, "catalog-months")
    df = df.withColumn(MONTH, F.substring("scraped_date", 1, 7))
    with _set(spark, {} if sort else SIDE_BY_SIDE):
        df.write.partitionBy(MONTH).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _gathered(df: DataFrame, files: int) -> DataFrame:
    """Rows of ``stored_by_month`` such that each month is written by at most ``files`` tasks, without a shuffle."""
    months = [r[0] for r in df.select(MONTH).distinct().limit(MONTHS + 1).collect()]  # bounded
    if not months or len(months) > MONTHS:
        return dealt_by(df, [MONTH], files)
    return reduce(DataFrame.unionByName, [df.filter(F.col(MONTH).eqNullSafe(F.lit(m))).coalesce(files) for m in months])


def write_months(stored: DataFrame, path: str, files_per_month: int) -> None:
    """Rows of ``stored_by_month`` written to the folders of their months under ``path``, each with at most
    ``files_per_month`` files; months that have no rows here keep what they hold."""
    with _set(stored.sparkSession, REPLACING):
        _gathered(stored, files_per_month).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def save_raw_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str = RAW_DATABASE,
                    files_per_month: int | None = None, by_month: bool = False) -> None:
    """Replace the contents of the raw tables (columns matched by name); of the
    listings, only the months that ``tables`` brings, with at most ``files_per_month`` files each.
    ``by_month``: the listings come from ``stored_by_month`` and are not stored again."""
    for name, df in tables.items():
        target = f"{database}.{name}"
        if name == "house" and files_per_month:
            df = _gathered(df if by_month else stored_by_month(df), files_per_month)
        elif name == "house" and not by_month:
            df = df.withColumn(MONTH, F.substring("scraped_date", 1, 7))
        with _set(spark, REPLACING):
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)


def register_months(spark: SparkSession, database: str = RAW_DATABASE) -> None:
    """Make months known whose folders another session or tool wrote."""
    spark.catalog.recoverPartitions(f"{database}.house")


def read_raw_tables(spark: SparkSession, database: str = RAW_DATABASE, months: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The raw tables by name; ``months`` (yyyy-MM) reads only these months of the listings."""
    tables = {name: spark.table(f"{database}.{name}") for name in schemas.FEEDS}
    if months is not None:
        tables["house"] = tables["house"].filter(F.col(MONTH).isin(list(months)))
    return {**tables, "house": tables["house"].drop(MONTH)}


def save_slices(spark: SparkSession, slices: dict[str, DataFrame], database: str, buckets: int,
                location: str | None = None, on: str = "id") -> None:
    """Slices as tables bucketed and sorted by ``on``, one file per bucket: joined on it
    (``operators.assemble``), they are read bucket by bucket without a shuffle. The
    number of buckets must be the same for slices that are joined; size them for a task's memory."""
    base = location or os.path.join(shared_dir(spark), "staylake", "slices", database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}'")
    for name, df in slices.items():
        (df.repartition(buckets, on).write.mode("overwrite").format("parquet").bucketBy(buckets, on).sortBy(on)
         .option("path", os.path.join(base, name)).saveAsTable(f"{database}.{name}"))


def read_slices(spark: SparkSession, names: Sequence[str], database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}
