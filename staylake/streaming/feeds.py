"""Incremental ingestion of the monthly listings feed.

New feed files dropped into a folder are picked up by a file-source stream.
Every micro-batch is (1) read with the options of the batch loader (checked
headers, doubled quotes, malformed rows fail), typed and filled; (2) written
into the raw table under ``scrape_month=../batch_id=..``, so that files of one
month that arrive in several batches add up while a repeated batch replaces
only its own rows; (3) read back from there, so that the text files are parsed
once, and merged into the type-2 history with all versions it holds. A batch writes the versions it closed and all open ones
together, to ``versions/batch=../part=closed`` and ``part=open``, without the columns that follow from
key and time; a row in ``commits`` written last publishes both. A repeated batch starts from the version before it, so
the result is the same after a lost executor or a restarted query, and does
not depend on how the files are dealt over batches as long as each listing's
rows arrive in time order.

``trigger(availableNow=True)`` processes everything new and stops (the
scheduled monthly run); the stream checkpoint remembers which files were
done, so the next run only reads files that arrived since.

``ingest_slices`` keeps all slices of a ``SnapshotStore`` instead of one history: a batch
reads and writes only the key-hash folders it has keys of, publishes all slices with
one commit row, and open versions that are no longer named can be removed. Its
raw rows lie under ``scrape_month=../load=..``. A load is the stream's id (kept in its
checkpoint) and the batch, and the commit row names it: a batch repeated after a loss is not merged
twice, and streams with checkpoints of their own add up in one store.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.functions.dates import SCRAPED_DATE_FORMAT, parse_date
from staylake.operators.history import scd2_bulk, scd2_line
from staylake.sources import schemas
from staylake.sources.feeds import coerce_types, csv_options, fill_defaults
from staylake.sources.sinks import write_table
from staylake.sources.snapshots import SnapshotStore

# key and time column of a history whose files leave out what follows from them
COMMIT = "batch bigint, columns string, together boolean, key string, updated_at string"


def _last_commit(spark: SparkSession, history_path: str, before: int | None):
    try:
        commits = spark.read.schema(COMMIT).parquet(f"{history_path}/commits")
        if before is not None:
            commits = commits.filter(F.col("batch") < before)
        return commits.orderBy(F.col("batch").desc()).first()
    except AnalysisException:  # nothing committed yet (path not found)
        return None


def latest_history(spark: SparkSession, history_path: str, before: int | None = None, open_only: bool = False) -> DataFrame | None:
    """The newest committed history (optionally as of before a batch, or only its open versions)."""
    last = _last_commit(spark, history_path, before)
    if last is None:
        return None
    parts = []
    if last.together:
        versions = spark.read.schema(f"{last.columns}, batch bigint, part string").parquet(f"{history_path}/versions")
        chosen = (F.col("part") == "open") & (F.col("batch") == last.batch)
        if not open_only:
            chosen = chosen | ((F.col("part") == "closed") & (F.col("batch") <= last.batch))
        parts.append(versions.filter(chosen).drop("batch", "part"))
    else:
        parts.append(spark.read.schema(last.columns).parquet(f"{history_path}/open/version={last.batch}"))
    if not open_only:
        try:  # versions closed by batches that wrote open and closed ones apart
            apart = spark.read.schema(f"{last.columns}, batch bigint").parquet(f"{history_path}/closed")
            parts.append(apart.filter(F.col("batch") <= last.batch).drop("batch"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    history = reduce(DataFrame.unionByName, parts)
    if last.key is None:  # written with all columns
        return history
    return scd2_bulk(history, last.key, last.updated_at, unique_key=True, valid_to=F.col("valid_to"))


def _written(spark: SparkSession, raw_path: str, schema: T.StructType, folder: str, value: int | str) -> DataFrame:
    """The rows a batch wrote into the raw table; only its own folders are listed."""
    try:
        return spark.read.schema(schema).option("basePath", raw_path).parquet(f"{raw_path}/scrape_month=*/{folder}={value}")
    except AnalysisException as missing:  # files without any row
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _stored_batch(spark: SparkSession, batch: DataFrame, raw_path: str, updated_at: str, folder: str, value: int | str) -> DataFrame:
    """A batch typed, filled and written into the raw table under ``scrape_month=../folder=value``, read back from there."""
    loaded = fill_defaults(coerce_types(batch, schemas.HOUSE_TYPES), schemas.HOUSE_FILL)
    loaded = loaded.withColumns({"scrape_month": F.substring(updated_at, 1, 7), folder: F.lit(value)})
    write_table(loaded, raw_path, partition_by=["scrape_month", folder], compression="zstd")
    return _written(spark, raw_path, loaded.schema, folder, value)


def _run_stream(spark: SparkSession, feed_glob: str, checkpoint: str, files_per_batch: int, with_id: bool,
                multi_line: bool, process: Callable[[DataFrame, int], None]) -> None:
    """Give the files that have come since the last run to ``process``, batch by batch."""
    schema = schemas.HOUSE_FEED
    if with_id:
        schema = T.StructType([T.StructField("id", T.LongType())] + schema.fields)
    stream = (spark.readStream.schema(schema).options(**csv_options(multi_line))
              .option("maxFilesPerTrigger", files_per_batch)
              .csv(feed_glob))
    query = (stream.writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def ingest_feed(spark: SparkSession, feed_glob: str, raw_path: str, history_path: str,
                checkpoint: str, key: str = "listing_id", updated_at: str = "scraped_date",
                history_columns: Sequence[str] = ("id", "listing_id", "scraped_date", "listing_neighbourhood"),
                order_by: Callable[[Column], Column] | None = None,
                files_per_batch: int = 1, with_id: bool = True, multi_line: bool = False) -> None:
    """Run the ingestion stream until all current files are processed."""
    order_by = order_by or (lambda c: parse_date(c, SCRAPED_DATE_FORMAT))

    def process(batch: DataFrame, batch_id: int) -> None:
        incoming = _stored_batch(spark, batch, raw_path, updated_at, "batch_id", batch_id).select(*history_columns)
        line = scd2_line(latest_history(spark, history_path, before=batch_id, open_only=True), incoming, key, updated_at, order_by)
        part = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        (line.withColumn("part", part).write.mode("overwrite").option("compression", "zstd")
         .partitionBy("part").parquet(f"{history_path}/versions/batch={batch_id}"))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in line.schema)
        row = spark.createDataFrame([(batch_id, columns, True, key, updated_at)], COMMIT)
        row.coalesce(1).write.mode("overwrite").parquet(f"{history_path}/commits/run={batch_id}")

    _run_stream(spark, feed_glob, checkpoint, files_per_batch, with_id, multi_line, process)


def ingest_slices(spark: SparkSession, feed_glob: str, raw_path: str, store: SnapshotStore, checkpoint: str,
                  updated_at: str = "scraped_date", files_per_batch: int = 1, multi_line: bool = False,
                  keep: int | None = None) -> None:
    """Run the ingestion stream into the slices of ``store`` until all current files are processed.

    ``keep``: after each batch, open versions that none of the last ``keep`` runs names are removed.
    The slices' columns must be in the feed, row ids included. One stream at a time writes to a store.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"{query_id}-{batch_id}"
        if store.run_of(load) is not None:
            return  # committed before the stream could note it
        store.run(_stored_batch(spark, batch, raw_path, updated_at, "load", load), source=load)
        if keep is not None:
            store.expire(keep)

    _run_stream(spark, feed_glob, checkpoint, files_per_batch, True, multi_line, process)
