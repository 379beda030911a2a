"""Token ids as length-delimited binary records with an offset index.

A shard ``part-N.rec`` holds one record per document:

    uint64  length of the payload
    uint32  masked checksum of the length's 8 bytes
    payload int64 document id, uint8 (1: the id is NULL), uint8 bytes per id, the ids
    uint32  masked checksum of the payload

all little-endian; ids take 2 bytes each in vocabularies of up to 65,536, else 4. The checksum is CRC-32, masked as rotated right by 15 bits
plus 0xA282EAD8, so that a record stored inside a record does not check out by
itself. ``part-N.idx`` has 16 bytes per record, its offset in the shard and its
size, so that records can be read in any order. The ``manifest`` table
has a row per shard with the ids and documents before it.

Documents stand in ascending id order over the shards in turn (NULL first;
rows of one id in the order of their texts' hashes). A task writes its shard
under a name of its own and renames it when complete, so a lost executor or a
second attempt leaves whole files only. The folder must be reachable from all
executors by a URI that pyarrow knows (a shared mount, HDFS, S3, GCS).

A NULL or empty text is the end id alone. Repeated rows are written each.
Extra columns are ignored; an empty table writes an empty manifest.
"""

from __future__ import annotations

import struct
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylake.llm.common import ship, whole_text
from staylake.llm.encode import encoded_slices

HEAD, TAIL, OWNER = "<QI", "<I", "<qBB"
HEAD_SIZE, TAIL_SIZE, OWNER_SIZE = (struct.calcsize(x) for x in (HEAD, TAIL, OWNER))
ENTRY = np.dtype([("offset", "<u8"), ("size", "<u8")])
SHARDS = "shard bigint, n_docs bigint, n_tokens bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack(TAIL, masked(length)) + payload + struct.pack(TAIL, masked(payload))


def unframe(data: bytes) -> bytes:
    """The payload of one whole record; raises if a checksum does not hold."""
    length, check = struct.unpack_from(HEAD, data)
    payload = data[HEAD_SIZE:HEAD_SIZE + length]
    if masked(data[:8]) != check or len(payload) != length or masked(payload) != struct.unpack_from(TAIL, data, HEAD_SIZE + length)[0]:
        raise ValueError("damaged record")
    return payload


def parse_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, missing, width = struct.unpack_from(OWNER, payload)
    return None if missing else doc, np.frombuffer(payload, f"<u{width}", offset=OWNER_SIZE).astype("<u4")


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _name(shard: int) -> str:
    return f"part-{shard:07d}"


def _write(folder: str, tokenizer, spaced: bool, end_id: int, width: int):
    def run(batches):
        task = TaskContext.get()
        shard, own = task.partitionId(), f"_{task.partitionId()}-{task.taskAttemptId()}"
        store, root = _place(folder)
        offset = n_tokens = 0
        index = []
        with store.open_output_stream(f"{root}/{own}.rec") as out:
            for part, encoded in encoded_slices(batches, "text", tokenizer.value, spaced, end_id):
                for doc, ids in zip(part.column(0).to_pylist(), encoded):
                    record = frame(struct.pack(OWNER, doc or 0, doc is None, width) + ids.astype(f"<u{width}").tobytes())
                    out.write(record)
                    index.append((offset, len(record)))
                    offset += len(record)
                    n_tokens += len(ids)
        if not index:
            store.delete_file(f"{root}/{own}.rec")
            return
        with store.open_output_stream(f"{root}/{own}.idx") as out:
            out.write(np.array(index, ENTRY).tobytes())
        for end in ("rec", "idx"):
            store.move(f"{root}/{own}.{end}", f"{root}/{_name(shard)}.{end}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "n_docs": pa.array([len(index)], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())})
    return run


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, spaced: bool, end_id: int, id_col: str = "doc_id",
                  text: str = "text", partitions: int | None = None) -> DataFrame:
    """Write ``docs`` as records under ``folder`` and return its manifest."""
    ship("staylake.llm.words", "staylake.llm.encode", "staylake.llm.records")
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    largest = max(end_id, *Tokenizer.from_str(tokenizer.value).get_vocab().values())
    width = 2 if largest < 1 << 16 else 4
    store, root = _place(folder)
    store.create_dir(f"{root}/data", recursive=True)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text).alias("text")).withColumns(
        {"hash": F.xxhash64("text"), "tie": F.monotonically_increasing_id()})  # ties are dealt out too
    order = ["doc_id", "hash", "tie"]
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    shards = dealt.select("doc_id", "text").mapInArrow(_write(f"{folder}/data", tokenizer, spaced, end_id, width), SHARDS)
    # one row per shard, written by one task: a file each would hold 24 bytes
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumns({"docs_before": F.coalesce(F.sum("n_docs").over(before), F.lit(0)),
                       "tokens_before": F.coalesce(F.sum("n_tokens").over(before), F.lit(0))}).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARDS + ", docs_before bigint, tokens_before bigint").parquet(f"{folder}/manifest")


def shard_records(folder: str, shard: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of one shard in file order, checked."""
    store, root = _place(f"{folder}/data")
    with store.open_input_stream(f"{root}/{_name(shard)}.rec") as f:
        while head := f.read(HEAD_SIZE):
            length, _ = struct.unpack(HEAD, head)
            yield parse_payload(unframe(head + f.read(length + TAIL_SIZE)))


def _shard_rows(folder: str):
    def run(batches):
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc, ids in shard_records(folder, shard):
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    ship("staylake.llm.records")
    manifest = read_manifest(spark, folder).select("shard", "tokens_before")
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(_shard_rows(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _entries(folder: str):
    def run(batches):
        store, root = _place(f"{folder}/data")
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{_name(shard)}.idx") as f:
                    index = np.frombuffer(f.read(), ENTRY)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(index), shard)), pa.array(index["offset"].astype(np.int64)),
                                                  pa.array(index["size"].astype(np.int64))], names=["shard", "offset", "size"])
    return run


def _seek(folder: str):
    def run(batches):
        store, root = _place(f"{folder}/data")
        for batch in batches:
            docs, ids = [], []
            for shard, offset, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with store.open_input_file(f"{root}/{_name(shard)}.rec") as f:
                    doc, own = parse_payload(unframe(f.read_at(size, offset)))
                docs.append(doc)
                ids.append(own.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])
    return run


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """All documents (``doc_id``, ``ids``) in an order drawn by ``seed``, by seeks through the index."""
    ship("staylake.llm.records")
    entries = read_manifest(spark, folder).select("shard").mapInArrow(_entries(folder), "shard bigint, offset bigint, size bigint")
    order = F.xxhash64(F.lit(seed), "shard", "offset")
    drawn = entries.withColumn("order", order).repartitionByRange("order").sortWithinPartitions("order").select("shard", "offset", "size")
    return drawn.mapInArrow(_seek(folder), "doc_id bigint, ids array<bigint>")
