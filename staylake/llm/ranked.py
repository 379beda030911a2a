"""Ranked lexical search: term at a time with limited accumulators, exact.

Documents and the postings of the query terms in them are written once, as one
row per document (its length and its query terms with their counts). Spark adds
up the number of documents, of words, and of documents per term. Then every task
goes through its documents in groups, turns a group's rows into postings per term,
and ranks it for each item:

* terms come rarest first; each has a bound, its weight times the largest impact
  it has in the group;
* while the bounds of the terms still to come can lift a new document to the k-th
  best partial score, a term's postings open accumulators; from then on they only
  add to those that are open, so survivors get their exact scores. A document
  without an accumulator would end strictly below the k-th, so ties are kept;
* survivors that cannot reach the k-th score any more are put aside.

The k-th score is carried from group to group of a task. The best k of every task
meet in a window per item, which is exact as scores depend on corpus-wide figures only.

Items are taken in blocks of at most ``BLOCK_TERMS`` terms (a longer item is a block
of its own): a block's terms are shipped to the tasks, the documents are read once
per block, and the work grows with the number of blocks.

NULL and empty texts and those without any term hold no document. Items without
terms, or whose terms occur nowhere, return nothing. Rows of one item id are one
item with the terms of all; repeated documents are ranked each; a NULL document
id comes last among equal scores, a NULL item id is an item. Very long texts are
read whole, in slices cut between terms. Extra columns are ignored, empty tables
give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm.common import saved, ship

BLOCK_TERMS = 500_000
GROUP_ROWS, GROUP_POSTINGS = 50_000, 4_000_000
SLICE = 1 << 20
# ASCII letters and digits and all bytes of other characters are parts of terms; only A-Z are lower-cased
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def slices(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice."""
    folded = text.encode("utf-8", "replace").translate(FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _counter(numbers: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [], [])
            for doc, text in zip(*batch.columns):
                length, found = 0, Counter()
                for terms in slices(text.as_py() or ""):
                    length += len(terms)
                    found.update(n for n in map(numbers.get, terms) if n is not None)
                if length:
                    for column, value in zip(out, (doc.as_py(), length, list(found), list(found.values()))):
                        column.append(value)
            if out[0]:
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32())),
                                       pa.array(out[3], pa.list_(pa.int64()))], ["doc", "length", "terms", "counts"])
    return count


class Group:
    """The postings of a group of documents, in order of their terms."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray, n: int, total: int):
        # ---- fixed values: the impact formula -------------------------------
        damp = np.array([8 * (10 + 90 * int(x) * n // total) for x in lengths], np.int64)
        rows = np.repeat(np.arange(len(lengths), dtype=np.int32), sizes)
        order = np.argsort(terms, kind="stable")
        self.rows, self.size = rows[order], len(lengths)
        tf = counts[order]
        self.impact = 1_000_000_000 * tf // (1_000 * tf + damp[self.rows])
        self.terms, start = np.unique(terms[order], return_index=True)
        self.start = np.append(start, len(order))
        self.most = np.maximum.reduceat(self.impact, start) if len(order) else self.impact

    def postings(self, terms: np.ndarray) -> list[int]:
        """Places in ``self.terms`` of those of ``terms`` that the group holds, in their order."""
        at = np.searchsorted(self.terms, terms)
        return [int(a) for a, t in zip(at, terms) if a < len(self.terms) and self.terms[a] == t]

    def rank(self, terms: np.ndarray, weight: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores that may be among the best k, given that a score below ``least`` is not."""
        places = self.postings(terms)
        w = [int(weight[self.terms[p]]) for p in places]
        left = np.cumsum([0, *[x * int(self.most[p]) for x, p in zip(w[::-1], places[::-1])]])[::-1]  # bounds of the terms from i on
        scores = np.zeros(self.size, np.int64)
        i, touched, kth = 0, None, least
        while i < len(places) and left[i] >= max(kth, 1):  # accumulators may be opened
            part = slice(self.start[places[i]], self.start[places[i] + 1])
            scores[self.rows[part]] += w[i] * self.impact[part]
            i += 1
            touched = np.flatnonzero(scores)
            if len(touched) >= k:
                kth = max(kth, int(np.partition(scores[touched], -k)[-k]))
        if touched is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        own = scores[touched]
        for j in range(i, len(places)):  # survivors only
            stay = own + left[j] >= kth
            touched, own = touched[stay], own[stay]
            a, b = self.start[places[j]], self.start[places[j] + 1]
            hit = np.searchsorted(self.rows[a:b], touched)
            found = np.flatnonzero((hit < b - a) & (self.rows[a + np.minimum(hit, b - a - 1)] == touched))
            own[found] += w[j] * self.impact[a + hit[found]]
            if len(own) >= k:
                kth = max(kth, int(np.partition(own, -k)[-k]))
        stay = own >= max(kth, 1)
        return touched[stay], own[stay]


def _searcher(items, weight, n: int, total: int, k: int):
    """``items`` broadcasts (number, terms rarest first) pairs, ``weight`` a weight per term."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}

        def run(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            flat = lambda c: (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c)
            terms, counts, docs = flat(table["terms"]), flat(table["counts"]), flat(table["doc"])
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
            group = Group(table["length"].to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy(), sizes, n, total)
            for item, own in items.value:
                top = best.get(item, [])
                rows, scores = group.rank(own, weight.value, k, top[-1][0] if len(top) >= k else 0)
                if len(rows):
                    if len(rows) > k:  # ties of the k-th stay
                        kth = np.partition(scores, -k)[-k]
                        rows, scores = rows[scores >= kth], scores[scores >= kth]
                    ids = docs.take(pa.array(rows)).to_pylist()
                    both = top + [(int(s), d) for s, d in zip(scores, ids)]
                    best[item] = sorted(both, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

        held, rows, postings = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, postings = rows + batch.num_rows, postings + len(batch.column(2).flatten())
            if rows >= GROUP_ROWS or postings >= GROUP_POSTINGS:
                run(held)
                held, rows, postings = [], 0, 0
        if rows:
            run(held)
        out = [(item, d, s) for item, top in best.items() for s, d in top]
        for at in range(0, len(out), 10_000):
            part = out[at:at + 10_000]
            yield pa.record_batch([pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int64()),
                                   pa.array([x[2] for x in part], pa.int64())], ["item", "doc", "score"])
    return search


def _blocks(benchmark: DataFrame, item_col: str, block_terms: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items and their distinct terms, in blocks; the driver holds one block at a time."""
    block, held, last, terms = [], set(), None, None
    rows = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col("text").cast("string").alias("text")).orderBy("item")
    for row in rows.toLocalIterator():
        own = {t for part in slices(row.text or "") for t in part}
        if block and row.item == last:
            terms |= own
        else:
            if block and len(held | own) > block_terms:
                yield block
                block, held = [], set()
            last, terms = row.item, own
            block.append((last, terms))
        held |= own
    if block:
        yield block


def weigh(n: int, df: int) -> int:
    # ---- fixed values: the weight formula ---------------------------------
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def search(docs: DataFrame, benchmark: DataFrame, k: int = 10, id_col: str = "doc_id", item_col: str = "item_id",
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item``, ``rank``, ``doc``, ``score``: every item's k best documents with a score above 0."""
    spark = docs.sparkSession
    ship(__name__)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    result = spark.createDataFrame([], "item bigint, rank int, doc bigint, score bigint")
    for block in _blocks(benchmark, item_col, block_terms):
        names = {t: i for i, t in enumerate(sorted({t for _, own in block for t in own}))}
        postings = saved(texts.mapInArrow(_counter(names), "doc bigint, length bigint, terms array<int>, counts array<bigint>"), "postings")
        n, total = postings.agg(F.count("*"), F.sum("length")).first()
        weight, df = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # a row per term of the block
            weight[row.term], df[row.term] = weigh(n, row["count"]), row["count"]
        own = [(i, np.array(sorted((names[t] for t in terms), key=lambda t: (df[t], t)), np.int64)) for i, (_, terms) in enumerate(block)]
        items, weights = spark.sparkContext.broadcast(own), spark.sparkContext.broadcast(weight)
        found = postings.mapInArrow(_searcher(items, weights, n, total or 1, k), "item int, doc bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
        best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id bigint")
        result = result.unionByName(saved(best.join(F.broadcast(ids), "item").select(F.col("item_id").alias("item"), "rank", "doc", "score"), "ranked"))
    return result
