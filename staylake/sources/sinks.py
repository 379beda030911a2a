"""Writing tables: idempotent partitioned overwrite and an empty-input guard."""

from __future__ import annotations

import time
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dealt_by(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows dealt so that each value of ``columns`` is written by at most ``files`` tasks: shuffled on
    the columns plus a hash of the row, which a retried task reproduces."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files))
    return df.repartition(*[F.col(c) for c in columns], salt)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet", mode: str = "overwrite",
                skip_empty: bool = True, header: bool = True,
                files_per_partition: int | None = None, compression: str | None = None, fast: bool = False) -> bool:
    """Write ``df``; with ``partition_by``, only the partitions present in
    ``df`` are replaced (dynamic overwrite), so re-running a month's load
    replaces that month instead of appending a second copy.

    An unpartitioned overwrite of an empty input would wipe the table; with
    ``skip_empty`` nothing is written then (one cheap ``isEmpty`` probe).
    ``files_per_partition`` bounds the files per partition value: rows are
    shuffled on the partition columns plus a hash of the row modulo that
    number, so each value (a month, say) is written by that many tasks, a
    large month never lands in one task, and every task writes few files
    instead of one per value it holds. The hash is of the row itself, so a
    retried task reproduces the same split. ``compression`` is a codec of the format
    (a compressed text file is read by one task); ``fast`` compresses gzip text less, in less time.

    Returns whether anything was written.
    """
    if skip_empty and not partition_by and df.isEmpty():
        return False
    if partition_by and files_per_partition:
        df = dealt_by(df, partition_by, files_per_partition)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if compression:
        writer = writer.option("compression", compression)
    if fast:
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)
    return True


def arrange_files(spark: SparkSession, path: str, header: Sequence[str]) -> int:
    """Files written to folders of a text partition at once, as if they had come folder by folder: their times follow
    the folders' order (no value first), and each folder gets as many files as the fullest, the further ones with
    a header line only. For streams, which take files in the order of their times. How many files a folder has."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def files(folder: str) -> list:
        return [f.getPath() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if not f.getPath().getName().startswith(("_", "."))]

    names = [f.getPath().getName() for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)) if f.isDirectory()]
    folders = [f"{path}/{n}" for n in sorted(names, key=lambda n: (not n.endswith("__HIVE_DEFAULT_PARTITION__"), n)) if "=" in n]
    held = {folder: len(files(folder)) for folder in folders}
    most = max(held.values(), default=0)
    for folder, n in held.items():
        if n < most:
            lines = spark.range(0, most - n, 1, most - n).select(F.lit(",".join(header)).alias("value"))
            staged = f"{path}/_headers"
            lines.write.mode("overwrite").option("compression", "gzip").text(staged)
            for file in files(staged):
                name = file.getName().replace(".txt.gz", ".csv.gz")
                if not fs.rename(file, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")):
                    raise OSError(f"{file} could not be moved to {folder}")
    now = int(time.time() * 1000) - 1000 * len(folders)
    for i, folder in enumerate(folders):
        for file in files(folder):
            fs.setTimes(file, now + 1000 * i, -1)
            if fs.getFileStatus(file).getModificationTime() // 1000 != (now + 1000 * i) // 1000:
                raise OSError(f"{path} keeps its own file times, so files cannot be put in order")
    return most
