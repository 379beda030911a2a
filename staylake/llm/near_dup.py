"""Near-duplicate documents: one-permutation MinHash with optimal densification,
banded buckets and star-shaped candidate edges, confirmed on full shingle sets.

1. Every whole text becomes its set of distinct five-word shingles (64-bit
   hashes), a 128-bin one-permutation signature and 32 band keys of 4 bins.
   Documents with equal sets (128-bit digest) form one class before anything
   is compared, so copies never meet each other in pairs.
2. A bucket is a band key shared by two classes or more. Its smallest member
   is the centre; the candidate edges are centre to member (a bucket of n
   gives n - 1 edges). Edges of two small sets (under ``SMALL`` shingles) are
   dropped only if their sizes forbid a link, as small sets fill few of the
   bins. Other edges are dropped if their signatures agree in under half of the
   bins: a chance of 3e-10 for a pair at 0.75 if 128 bins are independent; of
   20,000 simulated pairs of 192 of 256 shingles none agreed in under 77. The
   rest are confirmed on full sets.
3. A star can miss a link between two members that are both unlike the centre.
   So buckets that still span several components are gone through again (one of
   those that hold the same members): tasks compare them block against block, a
   block being about 2048 members or a million shingles at most. Pairs of
   different components are judged there and then: two small sets by counting
   their common shingles, others on the full sets if half of the bins agree; only links come out, one for each two
   components that a block pair ties together. No bucket is capped. A bucket of
   n members in different components costs n * n / 2 signature comparisons,
   spread over (n / 2048)**2 tasks.
4. Connected components over all confirmed links.

A link at similarity 0.75 shares no bucket with a chance of
(1 - 0.75**4)**32 = 5e-6; at 0.8 it is 5e-8.

NULL and empty texts have empty sets, are linked with nothing and stay. Rows
with one id count as one document. A NULL id is replaced by a hash of the
text for the search; the component id shown is then that hash. Extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm import minhash, words
from staylake.llm.common import in_small_batches, node_id, saved, ship, whole_text
from staylake.llm.components import components

SHINGLE, BINS, BAND_ROWS = 5, 128, 4
STAR_AGREE, CROSS_AGREE = 64, 64  # of 128 bins, see above
SMALL = 256  # sets below are never judged by their signatures
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
SET_BYTES = 1 << 18  # of text at once; numpy takes about 100 bytes for each


def _digest(doc: np.ndarray, h: np.ndarray, n: int, salt: int) -> np.ndarray:
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(words.mix(h ^ np.uint64(salt)), out=total[1:])
    at = np.searchsorted(doc, np.arange(n + 1))
    return words.mix(total[at[1:]] - total[at[:-1]]).view(np.int64)


def _fixed_binary(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    data = np.ascontiguousarray(matrix).tobytes()
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(data)])


def _sketch(k: int, bins: int, rows: int):
    def run(batches):
        for part, w in words.parsed_slices(batches, "text", lower=True, size=SET_BYTES):
            doc, h = minhash.shingle_sets(w, k)
            n = part.num_rows
            sig = minhash.signatures(doc, h, n, bins)
            size = np.bincount(doc, minlength=n)
            keys = minhash.band_keys(sig, rows).view(np.int64)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(size.astype(np.int64)), pa.array(_digest(doc, h, n, 1)), pa.array(_digest(doc, h, n, 2)),
                 keys, _fixed_binary((sig & np.uint64(255)).astype(np.uint8))],
                names=["node", "said", "n_shingles", "hi", "lo", "bands", "sig"])
    return run


def _confirm(k: int, percent: int):
    """Keeps the edges whose full shingle sets overlap by ``percent`` or more."""
    def sets(part: pa.RecordBatch, name: str):
        w = words.parse(*words.buffers(part.column(part.schema.get_field_index(name))), lower=True)
        doc, h = minhash.shingle_sets(w, k)
        return h, np.searchsorted(doc, np.arange(part.num_rows + 1))

    def run(batches):
        for batch in batches:
            for part in words.slices(batch, "text_v", SET_BYTES):
                (a, at_a), (b, at_b) = sets(part, "text_u"), sets(part, "text_v")
                common = np.array([len(np.intersect1d(a[at_a[i]:at_a[i + 1]], b[at_b[i]:at_b[i + 1]], assume_unique=True))
                                   for i in range(part.num_rows)], np.int64)
                both = np.diff(at_a) + np.diff(at_b) - common
                yield part.select(["u", "v"]).filter(pa.array((common > 0) & (100 * common >= percent * both)))
    return run


def _full_sets(k: int):
    def run(batches):
        for part, w in words.parsed_slices(batches, "text", lower=True, size=SET_BYTES):
            doc, h = minhash.shingle_sets(w, k)
            at = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32) * 8
            yield pa.RecordBatch.from_arrays([part.column(0), pa.Array.from_buffers(pa.binary(), part.num_rows, [
                None, pa.py_buffer(at), pa.py_buffer(h.tobytes())])], names=["node", "shingles"])
    return run


def _common(sets: list[np.ndarray]):
    """A function from a set to the numbers of its members that each of ``sets`` has."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]

    def count(a: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(flat, a), np.searchsorted(flat, a, side="right")
        n = hi - lo
        at = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
        return np.bincount(owner[at], minlength=len(sets))
    return count


def _cross(agree: int, percent: int):
    """Links between components inside one block pair; ``side`` 1 is a block against itself."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["side", "node"])
        left, right = pdf[pdf.side <= 1], pdf[pdf.side >= 1]
        ls, rs = (np.frombuffer(b"".join(x.sig), np.uint8).reshape(len(x), -1) for x in (left, right))
        sets = {node: np.frombuffer(x, np.uint64) for node, x in zip(pdf.node, pdf.shingles)}
        n_right = np.array([len(sets[x]) for x in right.node], np.int64)
        small = np.flatnonzero(n_right < SMALL)
        common_small = _common([sets[x] for x in right.node.iloc[small]])
        ln, rn, ll, rl = left.node.to_numpy(), right.node.to_numpy(), left.label.to_numpy(), right.label.to_numpy()
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        u, v = [], []
        for i in range(len(left)):
            other = np.flatnonzero(rl != ll[i])
            if left.side.iat[i] == 1:
                other = other[rn[other] > ln[i]]
            a = sets[ln[i]]
            near = (rs[other] == ls[i]).sum(axis=1) >= agree
            if len(a) < SMALL and len(small):
                common = common_small(a)
                linked = np.zeros(len(right), bool)
                linked[small] = (common > 0) & (100 * common >= percent * (len(a) + n_right[small] - common))
                near = np.where(n_right[other] < SMALL, linked[other], near)
            for j in other[near]:
                x, y, b = top(ll[i]), top(rl[j]), sets[rn[j]]
                if x == y or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                common = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * common >= percent * (len(a) + len(b) - common):
                    parent[x] = y
                    u.append(min(ln[i], rn[j]))
                    v.append(max(ln[i], rn[j]))
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})
    return run


def _agreeing(edges: DataFrame, sigs: DataFrame, agree: int, percent: int) -> DataFrame:
    """Edges whose signatures agree in ``agree`` bins or more; of two small sets, those whose sizes allow a link."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                a, c = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
                m, n = (b.column(i).to_numpy() for i in (4, 5))
                alike = 100 * np.minimum(m, n) >= percent * np.maximum(m, n)
                yield b.select(["u", "v"]).filter(pa.array(alike & ((np.maximum(m, n) < SMALL) | ((a == c).sum(axis=1) >= agree))))
    two = (edges.join(sigs.select(F.col("node").alias("v"), F.col("sig").alias("sig_v"), F.col("n_shingles").alias("n_v")), "v")
           .join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("sig_u"), F.col("n_shingles").alias("n_u")), "u"))
    return two.select("u", "v", "sig_u", "sig_v", "n_u", "n_v").mapInArrow(run, "u bigint, v bigint")


@in_small_batches
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when 100 * |A & B| >= percent * |A | B| over their
    shingle sets; ``component_id`` is the smallest id reachable and ``kept``
    marks the document that has it.
    """
    ship("staylake.llm.words", "staylake.llm.minhash", "staylake.llm.near_dup")
    rows = docs.select(node_id(id_col, text).alias("node"), whole_text(text).alias("text")).withColumn("said", F.xxhash64("text"))
    sketch = saved(rows.mapInArrow(_sketch(SHINGLE, BINS, BAND_ROWS),
                                   "node bigint, said bigint, n_shingles bigint, hi bigint, lo bigint, bands array<bigint>, sig binary"), "sketch")
    same = ["n_shingles", "hi", "lo"]
    full = sketch.filter("n_shingles > 0")
    # one class per distinct set, named by its smallest id; where that names several sets (an id with different
    # texts), all but one of them get a number above 2**62 from their digest
    named = full.groupBy(*same).agg(F.min(F.struct("node", "said")).alias("first"))
    named = saved(named.select(*same, "first.node", "first.said"), "sets-named")
    one = named.groupBy("node").agg(F.min(F.struct(*same)).alias("one"))
    own = F.xxhash64(*same).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    classes = saved(named.join(one, "node").withColumn("class", F.when(F.col("one") == F.struct(*same), F.col("node")).otherwise(own))
                    .select(*same, "class", "node", "said"), "classes")
    member = full.select("node", *same).join(classes.select(*same, "class"), same).select("node", "class")
    # all classes of one id are tied to its smallest
    several = member.groupBy("node").agg(F.min("class").alias("u"), F.max("class").alias("last")).filter("u < last").select("node", "u")
    ties = member.join(several, "node").select("u", F.col("class").alias("v")).filter("u < v").distinct()
    first = full.join(classes, [*same, "node", "said"]).dropDuplicates(["class"])
    reps = first.select(F.col("class").alias("node"), "n_shingles", "bands", "sig")

    key = reps.select("node", F.explode("bands").alias("key"))
    crowded = key.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("centre")).filter("size > 1")
    buckets = saved(key.join(crowded, "key"), "buckets")
    involved = buckets.select("node").distinct()
    sigs = saved(reps.select("node", "n_shingles", "sig").join(involved, "node").dropDuplicates(["node"]), "signatures")
    met = classes.join(involved.withColumnRenamed("node", "class"), "class").select("class", "node", "said")
    texts = saved(rows.join(met, ["node", "said"]).select(F.col("class").alias("node"), "text").dropDuplicates(["node"]), "texts")

    def confirmed(edges: DataFrame, label: str) -> DataFrame:
        pairs = (edges.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
                 .join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u"))
        return saved(pairs.select("u", "v", "text_u", "text_v").mapInArrow(_confirm(SHINGLE, percent), "u bigint, v bigint"), label)

    star = buckets.select(F.col("centre").alias("u"), F.col("node").alias("v")).filter("u <> v").distinct()
    links = confirmed(saved(_agreeing(star, sigs, STAR_AGREE, percent), "candidates"), "links").unionAll(ties)
    label = components(links)

    # buckets of three or more that still span several components, in blocks against blocks
    open_ = (buckets.filter("size > 2").join(label, "node", "left").join(sigs.select("node", "n_shingles"), "node")
             .select("key", "node", "n_shingles", F.coalesce("label", "node").alias("label")))
    weight = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    spread = (open_.groupBy("key").agg(F.ceil(weight).cast("int").alias("blocks"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                                       F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"))
              .filter("lo < hi").groupBy("n", "who").agg(F.min("key").alias("key"), F.max("blocks").alias("blocks")).select("key", "blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = open_.join(spread, "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = saved(placed.select("key", "node", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                                 F.when(F.col("block") == F.col("other"), 1).when(F.col("block") < F.col("other"), 0).otherwise(2).alias("side")), "blocks")
    sets = texts.join(placed.select("node").distinct(), "node", "left_semi").mapInArrow(_full_sets(SHINGLE), "node bigint, shingles binary")
    whole = saved(sets.join(sigs.select("node", "sig"), "node").dropDuplicates(["node"]), "sets")
    more = saved(placed.join(whole, "node").groupBy("key", "i", "j").applyInPandas(_cross(CROSS_AGREE, percent), "u bigint, v bigint").distinct(), "links")
    if not more.isEmpty():
        label = components(links.unionAll(more))

    of_class = (member.join(label.withColumnRenamed("node", "class"), "class", "left")
                .select("node", F.coalesce("label", "class").alias("component_id"))
                .groupBy("node").agg(F.min("component_id").alias("component_id")))
    return (sketch.select("node", "n_shingles").join(of_class, "node", "left")
            .select(F.col("node").alias("id"), "n_shingles", F.coalesce("component_id", "node").alias("component_id"))
            .withColumn("kept", F.col("id") == F.col("component_id")))
