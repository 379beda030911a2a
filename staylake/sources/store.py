"""Materialising raw tables in the shared folder.

The load stage (feed derivation, cleaning, surrogate keys) runs once; the
models then read the written Parquet, which also cuts the lineage so a lost
executor recomputes from files rather than from the feed joins.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from staylake.session import scratch_path


def materialize(spark: SparkSession, tables: dict[str, DataFrame], label: str = "raw") -> dict[str, DataFrame]:
    """Write every table as Parquet under a fresh folder and read it back.

    The writes are independent Spark jobs submitted together, so the small
    lookup tables are written while the large one is still running.
    """
    paths = {name: scratch_path(spark, label, name) for name in tables}

    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(paths[name])

    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        for done in [pool.submit(write, name) for name in tables]:
            done.result()
    return {name: spark.read.parquet(path) for name, path in paths.items()}
