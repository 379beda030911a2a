"""Exact deduplication as a stateful stream with disk-backed keyed state.

The folder of documents is read as a stream in several micro-batches. The
state is keyed by the SHA-256 of the normalised text and kept in RocksDB
without expiry (no watermark): per key the number of rows, the largest
document id (the stable identifier of the row that stays) and the content
locator of that row (file and row number). Each micro-batch writes the keys it
changed to its own folder, which a repeated batch overwrites. With a ``state_dir``
the stream's checkpoint, its RocksDB state and these folders stay there: a run
that was lost goes on where it ended, and a later run over the same folder streams
only the files that were added and meets the keys of all runs before. Without one
every run starts with empty state.

Then every hit (a digest seen more than once) is checked on full bytes: the
keeper's text is fetched by its locator and compared with the text of each
other row. Keepers of large groups are copied over as many salts as the group
has thousands of rows, so no key's rows meet in one task. Rows whose bytes
differ (a digest collision) are grouped again by digest and whole text.

Only DataFrame functions run on the executors.

A NULL text counts as empty. Texts are equal when identical after lower-casing
A-Z only. Among rows that share the largest id the last one by file and row
stays; a NULL id is smaller than any other. Identical rows are told apart by
their locators. Very long texts are hashed and compared whole. Extra columns are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm.common import as_row, saved, whole_text
from staylake.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALT_ROWS = 1000
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # a store takes the disk it fills
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.metricsEnabled": "false",
}


def normalised(text: str = "text") -> Column:
    return F.translate(whole_text(text), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def located(rows: DataFrame) -> DataFrame:
    """The rows of a file scan with their content locator ``file``, ``row``."""
    return rows.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})


def run_state(spark: SparkSession, path: str, id_col: str, text: str, batches: int,
              digest: Callable[[Column], Column], state_dir: str | None = None) -> DataFrame:
    """Stream the folder through the keyed state; its final content, one row per digest.

    ``state_dir`` is a folder all executors share; it belongs to one ``path``, ``id_col``, ``text`` and ``digest``.
    """
    source = spark.read.parquet(path)
    names = source.inputFiles()
    files = max(1, -(-len(names) // batches))
    path = path.rstrip("/")
    state_dir = (state_dir or scratch_path(spark, "llm", "dedup-state")).rstrip("/")
    if len(names) == 1 and names[0].endswith("/" + path.rpartition("/")[2]):
        path = f"{path[:-1]}[{path[-1]}]"  # one file: a stream takes it as a pattern, not as a folder
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", files).parquet(path)
    stream = located(stream).select(digest(normalised(text)).alias("digest"), F.struct(F.col(id_col).cast("bigint").alias("id"), "file", "row").alias("at"))
    state = stream.groupBy("digest").agg(F.count("*").alias("group_size"), F.max("at").alias("keep"))
    changes = f"{state_dir}/changes"

    def emit(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{changes}/batch={batch}")

    query = (state.writeStream.outputMode("update").foreachBatch(emit).trigger(availableNow=True)
             .option("checkpointLocation", f"{state_dir}/checkpoint").start())
    query.awaitTermination()
    schema = "digest binary, group_size bigint, keep struct<id: bigint, file: string, row: bigint>"
    written = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(changes) if _exists(spark, changes) else spark.createDataFrame([], schema)
    # counts only grow, so a key's last change is the one with the largest count
    return written.groupBy("digest").agg(F.max(F.struct("group_size", "keep")).alias("s")).select("digest", "s.group_size", "s.keep")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def exact_duplicates(spark: SparkSession, path: str, id_col: str = "doc_id", text: str = "text", batches: int = 4,
                     digest: Callable[[Column], Column] = sha256, state_dir: str | None = None) -> DataFrame:
    """One row per row of the Parquet folder ``path``: ``id``, ``file``, ``row``, ``keep_id``,
    ``keep_file``, ``keep_row`` (the locator of the row that stays), ``group_size``, ``kept``, ``text_sha256``.

    ``batches`` is the number of micro-batches the files are dealt over; it does
    not change the result. ``digest`` is replaceable for tests of collisions. With a ``state_dir`` (see
    ``run_state``) files may be added to ``path`` between runs, but not changed or removed.
    """
    with _settings(spark, STATE_CONF):
        state = saved(run_state(spark, path, id_col, text, batches, digest, state_dir), "dedup-keys")
    rows = located(spark.read.parquet(path)).select(
        F.col(id_col).cast("bigint").alias("id"), "file", "row", normalised(text).alias("text"), digest(normalised(text)).alias("digest"))
    # every row meets its key's state; only hits carry their text on
    hit = F.col("group_size") > 1
    keeps = F.col("file").eqNullSafe(F.col("keep.file")) & F.col("row").eqNullSafe(F.col("keep.row"))
    seen = saved(rows.join(state, "digest").select(
        "id", "file", "row", "digest", F.sha2("text", 256).alias("text_sha256"), "group_size", "keep", keeps.alias("kept"),
        F.when(hit, F.col("text")).alias("text")), "dedup-seen")
    salts = F.ceil(F.col("group_size") / SALT_ROWS).cast("int")
    keepers = (seen.filter(hit & F.col("kept")).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
               .select("digest", "salt", F.col("text").alias("keep_text")))
    others = (seen.filter(hit & ~F.col("kept")).withColumn("salt", F.pmod(F.xxhash64("file", "row"), salts).cast("int"))
              .join(keepers, ["digest", "salt"]))
    result = ["id", "file", "row", F.col("keep.id").alias("keep_id"), F.col("keep.file").alias("keep_file"),
              F.col("keep.row").alias("keep_row"), "group_size", "kept", "text_sha256"]
    checked = saved(others.select("id", "file", "row", "digest", "text_sha256", "group_size", "keep", "kept",
                                  (F.col("text") == F.col("keep_text")).alias("same")), "dedup-checked")
    collided = checked.filter(~F.col("same")).select("digest").distinct()
    plain = seen.filter(~hit | F.col("kept")).select("digest", *result).unionByName(checked.filter("same").select("digest", *result))
    if collided.isEmpty():
        return plain.drop("digest")
    again = seen.filter(hit).join(collided, "digest", "left_semi").drop("keep", "group_size", "kept")
    groups = (again.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "file", "row")).alias("keep")))
    regrouped = (again.join(groups, ["digest", "text"]).withColumn("kept", keeps).select(*result))
    return plain.join(collided, "digest", "left_anti").drop("digest").unionByName(regrouped)


def staged(docs: DataFrame) -> str:
    """Write a DataFrame's rows to the shared folder, for ``exact_duplicates``; the folder's path."""
    path = scratch_path(docs.sparkSession, "llm", "dedup-staged")
    docs.write.parquet(path)
    return path


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    spark = docs.sparkSession
    path = staged(docs)
    found = exact_duplicates(spark, path, id_col, text).filter("kept").select("file", F.col("row").alias("place"))
    rows = spark.read.schema(docs.schema).parquet(path).select(as_row(docs), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    return rows.join(found, ["file", "place"], "left_semi").select("row.*")
