"""The corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``docs`` is what
the stage before kept, written as Parquet and read again. All stages but the
last return the columns of ``documents``. Nulls in any column, empty and very long
texts, repeated rows and ids, empty tables and further columns of any name pass
through; a stage's docstring says what it does with them. Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm import common, decontaminate, exact_dedup, near_dup, packing, queries, toxicity

BROADCAST_NUMBERS = 1_000_000  # row numbers, about 56 bytes each in a task's hash table


def _held(docs: DataFrame) -> DataFrame:
    """The rows as one struct ``row`` and numbered, written once: stages judge rows by their number, so
    that neither repeated or missing ids nor columns named like an operator's own matter."""
    return common.saved(docs.select(common.as_row(docs), F.monotonically_increasing_id().alias("number")), "stage-input")


def _without(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows of ``_held`` whose number is not in ``numbers``. Counted to be at most ``BROADCAST_NUMBERS``, the
    numbers go to the rows and no text is moved; more of them and the rows are shuffled by number."""
    numbers = common.saved(numbers, "stage-dropped")
    if numbers.count() <= BROADCAST_NUMBERS:
        numbers = F.broadcast(numbers)
    return rows.join(numbers, "number", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts are scored like others; repeated rows get equal scores and stay or go together."""
    labels = common.table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    scored = model.score(docs.select(common.as_row(docs), F.col("text")))
    return scored.filter("predicted = 0").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null counts as empty) the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id (null last, then the first row).
    Rows count as documents of their own, also those that share an id; texts without words all stay."""
    rows = _held(docs)
    groups = near_dup.near_duplicates(rows.select("number", F.col("row.text").alias("text")), id_col="number")
    member = rows.select("number", F.col("row.doc_id").alias("doc")).join(groups.select(F.col("id").alias("number"), "component_id"), "number")
    kept = member.groupBy("component_id").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "number"))["number"].alias("number"))
    return _without(rows, rows.select("number").join(kept, "number", "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row that overlaps a benchmark item goes; null and empty texts overlap nothing."""
    rows = _held(docs)
    found = decontaminate.overlaps(rows.select("number", F.col("row.text").alias("text")), common.table(spark, sf_dir, "benchmark"), id_col="number")
    return _without(rows, found.select(F.col("id").alias("number")).distinct())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts are the end id alone; repeated rows are packed each."""
    return packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None  # toxicity, MinHash and packing are beyond SQL; tests/llm holds them against brute force
