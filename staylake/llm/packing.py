"""Bounded-space online best-fit packing of token sequences.

Documents are encoded (``encode.py``) and get the end id; only longer ones are
cut, into pieces of ``capacity`` tokens of which the first may be shorter.
Each task packs its pieces as they come: at most ``open_bins`` sequences are
open, a bitset holds the free spaces that occur among them, a piece goes to the
open sequence with the least space that fits, and when a new one is needed and
all are in use, the fullest is closed first.

What is still open when a task ends is packed again: the open sequences of 16
tasks meet in one (at most 16 x ``open_bins`` sequences, however large the
input), largest pieces first, which stay open together; of the result the
``open_bins`` emptiest sequences stay open and meet those of other groups, level
by level, until one group is left. So the space lost at the tasks' ends does
not grow with the number of tasks.

A NULL or empty text is the end id alone. Repeated rows are packed each. A NULL
id stays NULL. Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import in_small_batches, saved, ship, whole_text
from staylake.llm.encode import encoded_slices

FAN_IN = 16
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", task bigint, bin bigint, offset bigint, open boolean"


class BestFit:
    """Open bins of one packer, by free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = 0  # bit f: some open bin has f tokens free
        self.n_open = self.n_bins = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        b = bins.pop()
        if not bins:
            self.spaces &= ~(1 << space)
        self.n_open -= 1
        return b

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to ``capacity`` tokens."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            b = self._take(space)
        else:
            if self.n_open >= self.limit:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
            b, space = self.n_bins, self.capacity
            self.n_bins += 1
        if space > length:
            self.by_space[space - length].append(b)
            self.spaces |= 1 << (space - length)
            self.n_open += 1
        return b, self.capacity - space

    def open(self, most: int | None = None) -> set[int]:
        """The open bins, or the ``most`` emptiest of them."""
        emptiest = [b for bins in reversed(self.by_space) for b in bins]
        return set(emptiest[:most])


def _pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def _encode_and_pack(tokenizer, spaced: bool, end_id: int, capacity: int, open_bins: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        packer, rows = BestFit(capacity, open_bins), []
        for part, encoded in encoded_slices(batches, "text", tokenizer.value, spaced, end_id):
            for doc, ids in zip(part.column(0).to_pylist(), encoded):
                raw = ids.astype("<u4").tobytes()
                for i, (start, length) in enumerate(_pieces(len(ids), capacity)):
                    b, offset = packer.put(length)
                    rows.append((doc, i, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), task, b, offset))
        # which bins stay open is known at the end only; rows are a few dozen bytes each
        still = packer.open()
        for i in range(0, len(rows), 10_000):
            cols = list(zip(*rows[i:i + 10_000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.int64()] * 6))] + [pa.array([b in still for b in cols[6]])],
                names=[x.split()[0] for x in PLACED.split(", ")])
    return run


def _pack_again(capacity: int, open_bins: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "task", "bin", "offset"], ascending=[False, True, True, True], kind="stable")
        packer = BestFit(capacity, FAN_IN * open_bins)
        placed = [packer.put(int(n)) for n in pdf.length]
        still = set() if last else packer.open(open_bins)
        pdf = pdf.assign(task=pdf["group"], bin=[b for b, _ in placed], offset=[o for _, o in placed])
        return pdf.assign(open=[b in still for b in pdf.bin]).drop(columns="group")
    return run


@in_small_batches
def pack(docs: DataFrame, tokenizer_path: str, spaced: bool = True, end_id: int = 0, id_col: str = "doc_id", text: str = "text",
         capacity: int = 2048, open_bins: int = 1024) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    ship("staylake.llm.words", "staylake.llm.encode", "staylake.llm.packing")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text).alias("text"))
    level = 0
    placed = saved(rows.mapInArrow(_encode_and_pack(tokenizer, spaced, end_id, capacity, open_bins), PLACED), "pieces")
    done = [placed.filter(~F.col("open")).withColumn("level", F.lit(level))]
    tasks = (placed.agg(F.max("task")).first()[0] or 0) + 1
    while tasks:
        level += 1
        last = tasks <= FAN_IN
        left = placed.filter("open").withColumn("group", F.floor(F.col("task") / FAN_IN).cast("bigint"))
        placed = saved(left.groupBy("group").applyInPandas(_pack_again(capacity, open_bins, last), PLACED), "pieces")
        done.append(placed.filter(~F.col("open")).withColumn("level", F.lit(level)))
        tasks = 0 if last else -(-tasks // FAN_IN)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    # level, task and bin side by side
    number = F.col("level") * F.lit(1 << 60) + F.col("task") * F.lit(1 << 28) + F.col("bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", number.cast("bigint").alias("sequence_id"), "offset")
