"""Hard negatives by inner product, found with R-trees packed by sort-tile-recursive.

Components become floor(256 * x), so that scores are whole numbers. Building: rows
are range-partitioned by label, the coordinate of widest spread and row number
(the outermost tiles, cut by Spark; the row number cuts through equal vectors), and
every partition is tiled on: sort by a coordinate, cut into slabs, sort each slab by
the next coordinate, until a slab is a leaf page of ``LEAF_ROWS`` rows of one
label. A page is written as one row with its bounding box.

Searching: anchors come in blocks of at most ``ANCHOR_BLOCK``, shipped to the tasks; a
task reads its pages, packs consecutive pages of a label into the upper levels, and
goes through the boxes with a best-first queue. A box [lo, hi] gives each coordinate
the interval between anchor * lo and anchor * hi, and the sums of their ends bound the inner product of
all rows inside. Boxes that lie outside every score window asked for, or strictly
below the k-th score found so far, are pruned; all others are opened and their rows
scored exactly. The best of all tasks meet in a window per anchor, so results are
exact (recall 1). First the positives are found (same label, no score window),
then the negatives of all positives of an anchor in one pass (other labels, a
window per positive).

All rows are indexed. The spread of coordinates is looked at on ``AXIS_SAMPLE`` rows,
which only chooses the tiling. Work is anchors x rows in the worst case, as the
task has it; in many dimensions boxes are wide and prune little.

Rows with a NULL label, a NULL vector or a NULL or non-finite component take no
part. Missing components of shorter vectors count as 0. Repeated rows are rows of
their own, but no row with the anchor's id is its positive; an anchor given twice
returns its rows twice. Among equal scores the smaller id comes first, a NULL id last.
Pairs whose score is beyond 64 bits are left out. Extra columns are ignored, empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm.common import numbered, saved, ship

LEAF_ROWS, TILE_ROWS, FANOUT, TREE_PAGES = 64, 16_384, 16, 1024
ANCHOR_BLOCK, AXIS_SAMPLE = 4096, 2000
EXACT = float(1 << 53)
ANY = (-(1 << 63), (1 << 63) - 1)  # all scores of 64 bits
PAGE = "label bigint, dims int, ids array<bigint>, cells binary, low binary, high binary"


def rows_of(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """The rows that take part: id, label, components as whole numbers in doubles, row."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    own = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                         F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * 256).alias("v"))
    own = own.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))
    return own.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)))


def tiles(v: np.ndarray, at: np.ndarray, axes: np.ndarray, used: int = 0) -> Iterator[np.ndarray]:
    """Leaf pages of the rows ``at``, by sort-tile-recursive over ``axes``."""
    pages = -(-len(at) // LEAF_ROWS)
    if pages <= 1:
        yield at
        return
    left = len(axes) - used
    slabs = max(2, int(np.ceil(pages ** (1 / left)))) if left > 1 else pages
    size = -(-pages // slabs) * LEAF_ROWS
    if left:
        at = at[np.argsort(v[at, axes[used]], kind="stable")]
    for a in range(0, len(at), size):
        yield from tiles(v, at[a:a + size], axes, min(used + 1, len(axes)))


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones filled with 0."""
    sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    if not len(sizes) or (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1) if len(flat) else np.zeros((len(sizes), 0))
    out = np.zeros((len(sizes), sizes.max()))
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pages(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        v, label, ids = matrix(table["v"].chunk(0)), table["label"].to_numpy(), table["id"].chunk(0)
        out = []
        for own in np.unique(label):
            at = np.flatnonzero(label == own)
            axes = np.argsort(-np.ptp(v[at], axis=0), kind="stable") if v.shape[1] else np.zeros(0, int)
            for page in tiles(v, at, axes):
                part = v[page]
                out.append((int(own), v.shape[1], ids.take(pa.array(page)).to_pylist(), part.tobytes(), part.min(axis=0).tobytes(), part.max(axis=0).tobytes()))
        types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], ["label", "dims", "ids", "cells", "low", "high"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 2 * TILE_ROWS:
            yield pages(held)
            held, rows = [], 0
    if rows:
        yield pages(held)


def build(rows: DataFrame) -> DataFrame:
    """The leaf pages of all rows."""
    ship(__name__)
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sample = [r.v for r in rows.select("v").limit(AXIS_SAMPLE).collect()]
    spread = np.ptp(matrix(pa.array(sample, pa.list_(pa.float64()))), axis=0) if sample else np.zeros(0)
    axis = int(spread.argmax()) + 1 if len(spread) else 1
    parts = -(-rows.count() // TILE_ROWS) or 1
    dealt = rows.repartitionByRange(parts, "label", F.coalesce(F.try_element_at("v", F.lit(axis)), F.lit(0.0)), "row")
    return saved(dealt.select("id", "label", "v").mapInArrow(_pack, PAGE), "pages")


class Tree:
    """Boxes of one label: pages below, then ``FANOUT`` consecutive boxes in each above."""

    def __init__(self, pages: list[dict], dims: int, whole: bool):
        fit = lambda x, p: np.pad(np.frombuffer(x).reshape(-1, p["dims"]), ((0, 0), (0, dims - p["dims"])))
        cast = (lambda x: x) if whole else (lambda x: np.array([[int(c) for c in row] for row in x], object).reshape(x.shape))
        self.cells = [cast(fit(p["cells"], p) if p["dims"] else np.zeros((len(p["ids"]), dims))) for p in pages]
        self.ids = [p["ids"] for p in pages]
        self.levels = [tuple(np.concatenate([cast(fit(p[c], p) if p["dims"] else np.zeros((1, dims))) for p in pages]) for c in ("low", "high"))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            start = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)))

    def bounds(self, level: int, a: int, b: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = (x[a:b] for x in self.levels[level])
        return low @ up + high @ down, high @ up + low @ down


class Best:
    """The best k (score, id) pairs within a score window."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high, self.top = k, low, high, []

    def least(self):
        return max(self.low, self.top[-1][0]) if len(self.top) >= self.k else self.low

    def add(self, scores: np.ndarray, ids: list, own: int | None) -> None:
        at = np.flatnonzero((scores >= self.least()) & (scores <= self.high))
        if len(at):
            both = self.top + [(int(scores[i]), ids[i]) for i in at if own is None or ids[i] != own]
            self.top = sorted(both, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:self.k]


def explore(trees: list[Tree], vector: np.ndarray, best: list[Best], own: int | None = None) -> None:
    """Best-first through the boxes of ``trees``; rows with the id ``own`` are left out."""
    zero = vector * 0
    up, down = np.maximum(vector, zero), np.minimum(vector, zero)
    high = np.array([b.high for b in best], object if vector.dtype == object else float)

    def least() -> np.ndarray:
        return np.array([b.least() for b in best], high.dtype)

    queue, made = [], 0

    def push(tree: Tree, level: int, a: int, b: int) -> None:
        nonlocal made
        lows, highs = tree.bounds(level, a, b, up, down)
        wanted = ((highs[:, None] >= least()) & (lows[:, None] <= high)).any(axis=1)
        for i in np.flatnonzero(wanted):
            made += 1
            heapq.heappush(queue, (-highs[i], made, lows[i], tree, level, a + int(i)))

    for tree in trees:
        push(tree, len(tree.levels) - 1, 0, 1)
    while queue:
        upper, _, lower, tree, level, node = heapq.heappop(queue)
        now = least()
        if -upper < now.min():
            break
        if not ((-upper >= now) & (lower <= high)).any():
            continue
        if level:
            push(tree, level - 1, node * FANOUT, min((node + 1) * FANOUT, len(tree.levels[level - 1][0])))
        else:
            scores = tree.cells[node] @ vector
            for b in best:
                b.add(scores, tree.ids[node], own)


def _searcher(block, same_label: bool, k: int):
    """``block`` broadcasts anchors: number, id, label, vector, score windows."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = [[Best(k, low, high) for low, high in a[4]] for a in anchors]

        def run(pages: list[dict]) -> None:
            dims = max(max(p["dims"] for p in pages), max(len(a[3]) for a in anchors))
            vectors = [np.pad(a[3], (0, dims - len(a[3]))) for a in anchors]
            most = max((np.abs(np.frombuffer(p[c])).max() for p in pages for c in ("low", "high") if p["dims"]), default=0.0)
            whole = [float(np.abs(v).max(initial=0)) < EXACT / max(most, 1) / max(dims, 1) for v in vectors]
            by_label: dict[int, list[dict]] = {}
            for p in pages:
                by_label.setdefault(p["label"], []).append(p)
            forest = {w: {lb: Tree(own, dims, w) for lb, own in by_label.items()} for w in set(whole)}
            for (_, own, label, _, windows), vector, w, tops in zip(anchors, vectors, whole, best):
                if windows:
                    trees = [t for lb, t in forest[w].items() if (lb == label) == same_label]
                    explore(trees, vector if w else np.array([int(x) for x in vector], object), tops, own if same_label else None)

        held = []
        for batch in batches:
            for page in batch.to_pylist():
                held.append(page)
                if len(held) >= TREE_PAGES:
                    run(held)
                    held = []
        if held:
            run(held)
        out = [(a[0], j, s, i) for a, tops in zip(anchors, best) for j, b in enumerate(tops) for s, i in b.top]
        for at in range(0, len(out), 10_000):
            part = out[at:at + 10_000]
            yield pa.record_batch([pa.array([x[i] for x in part], pa.int64()) for i in range(4)], ["anchor", "place", "score", "found"])
    return search


FOUND = "anchor bigint, place bigint, score bigint, found bigint"


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("found").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100,
         anchor_block: int = ANCHOR_BLOCK, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of other labels with a score from ``least`` to ``most`` percent of the positive's."""
    spark = vectors.sparkSession
    ship(__name__)
    rows = rows_of(vectors, id_col, label_col, vector_col)
    pages = build(rows)
    anchors = saved(numbered(rows.filter(F.col("id") % every == 0), "number"), "anchors")
    result = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    for at in range(0, anchors.count(), anchor_block):
        part = anchors.filter(F.col("number").between(at, at + anchor_block - 1))
        block = [(r.number, r.id, r.label, np.array(r.v, float), [ANY]) for r in part.collect()]  # at most anchor_block rows
        near = pages.mapInArrow(_searcher(spark.sparkContext.broadcast(block), True, positives), FOUND)
        near = saved(_first(near, ["anchor"], positives).select("anchor", F.col("rank").cast("bigint").alias("place"), "score", "found"), "positives")
        windows: dict[int, list] = {}
        for r in near.orderBy("anchor", "place").collect():  # at most ``positives`` rows per anchor
            windows.setdefault(r.anchor, []).append((-(-least * r.score // 100), most * r.score // 100))
        block = [(*a[:4], windows.get(a[0], [])) for a in block]
        far = pages.mapInArrow(_searcher(spark.sparkContext.broadcast(block), False, negatives), FOUND)
        far = _first(far.withColumn("place", F.col("place") + 1), ["anchor", "place"], negatives)
        told = (near.withColumnsRenamed({"found": "positive_id", "score": "positive_score"})
                .join(part.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id")), "anchor"))
        mined = far.withColumnsRenamed({"found": "negative_id", "score": "negative_score"}).join(told, ["anchor", "place"])
        result = result.unionByName(saved(mined.select(*result.columns), "mined"))
    return result
