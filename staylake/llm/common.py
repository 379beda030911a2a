"""Helpers shared by the operators: shared-folder tables and code shipping."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylake.session import scratch_path


def ship(*modules: str) -> None:
    """Send these modules' code with the tasks, so that executors need no copy of the library."""
    for name in modules:
        cloudpickle.register_pickle_by_value(importlib.import_module(name))


BATCH_BYTES = 4 << 20


def in_small_batches(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """While ``operator`` runs on its first argument, Spark sends rows to Python in batches of about ``BATCH_BYTES``
    (else 10,000 rows, however long): an executor and its workers hold a batch several times over."""
    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
        held = conf.get(key, None)
        conf.set(key, str(BATCH_BYTES))
        try:
            return operator(docs, *args, **kwargs)
        finally:
            conf.unset(key) if held is None else conf.set(key, held)
    return run


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def node_id(id_col: str, text: str = "text") -> Column:
    """The document's integer id; a row without one gets a number above 2**62 from its text."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.xxhash64(whole_text(text)).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62))


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that none can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Row numbers 0, 1, 2, .. in ``name``, in the order of ``df``'s partitions and rows.

    The table is written once with each row's place, so that the numbers stay what they are;
    only the row counts per write task are added up, one row each.
    """
    placed = saved(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(name, 33)
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(parts), part == F.col("_part"))  # a row per write task
            .withColumn(name, F.col("_before") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before"))
