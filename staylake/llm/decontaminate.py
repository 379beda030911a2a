"""Benchmark decontamination by spaced-seed hashing.

Texts become lower-case tokens (runs of letters and digits). A seed is the hash of
the tokens that a fixed mask keeps of a stretch; what stands in the mask's holes does
not matter, so a seed survives substitutions there. Seeds of all positions of the
benchmark meet those of all positions of all documents.

Masks (``family``) are chosen by a greedy cover: an alignment is accepted if a
stretch of s tokens agrees in all but m of them, and every choice of m spoiled
tokens must leave one of the masks whole at some place, so that no accepted
alignment lacks a hit. For 20 tokens with 4 spoiled, four masks that keep 7 tokens
each do; shorter items have masks of fewer tokens (15: three of 6, 10: three of 5, 5: two of 3),
and items of which no token may differ (under five) are hashed whole. Positions
whose adjacent kept tokens at a mask's ends occur nowhere in the benchmark are
passed over before hashing (while the benchmark has at most ``KNOWN_PAIRS`` pairs;
the result is the same without).

Each alignment is then verified token by token: it counts if some stretch of
``min(window, item length)`` aligned tokens agrees in ``share`` of them.
Substitutions are tolerated. Alignments are never added up: an inserted or dropped
token ends one, and the item is lost if no side of it is accepted by itself.
Items under five tokens (at 80 %) must agree whole.

The benchmark's seeds are broadcast only when counted to be at most
``BROADCAST_SEEDS``; beyond that both sides are shuffled by hash. Only DataFrame
functions are used.

Hits are gathered per document and ``STRETCH`` alignments, so that a long text's hits do not
meet in one row. Very long texts are read whole.

NULL and empty texts have no tokens; items without tokens match nothing.
Repeated documents are reported each, repeated items once. A NULL document id
is found under a hash of its text and reported as NULL. Extra columns are
ignored, empty tables give an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import node_id, saved, whole_text

KNOWN_PAIRS = 50_000
WINDOW, SHARE = 20, 0.8
BROADCAST_SEEDS = 1_000_000
STRETCH = 4096
FEW, WEIGHTS, SPAN = 4, range(7, 1, -1), 20


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _coded(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the token hashes ``h`` and the hashes of adjacent pairs ``p``."""
    df = df.withColumn("h", F.transform(tokens(F.col(text)), lambda t: F.xxhash64(t)))
    pairs = F.transform(F.sequence(F.lit(0), F.size("h") - 2), lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1)))
    return df.withColumn("p", F.when(F.size("h") > 1, pairs).otherwise(F.array().cast("array<bigint>")))


def _masks(weight: int, stretch: int) -> list[tuple[int, ...]]:
    """All masks of a weight with a hole, as kept offsets; heavier ones begin and end with two kept tokens."""
    ends = 2 if weight >= 5 else 1
    out = []
    for span in range(weight + 1, stretch + 1):
        for middle in combinations(range(ends, span - ends), weight - 2 * ends):
            out.append((*range(ends), *middle, *range(span - ends, span)))
    return out


@lru_cache(maxsize=None)
def family(stretch: int, spoiled: int) -> tuple[tuple[int, ...], ...]:
    """The masks for ``stretch`` tokens of which ``spoiled`` may differ: the heaviest family of at most ``FEW``
    masks one of which is left whole by every choice of spoiled tokens."""
    if not spoiled:
        return (tuple(range(stretch)),)
    parts = -(-stretch // SPAN)
    if parts > 1:  # one of the parts has no more than its share of the spoiled tokens
        return family(stretch // parts, spoiled // parts)
    patterns = np.array([sum(1 << p for p in c) for c in combinations(range(stretch), spoiled)])
    for weight in WEIGHTS:
        masks = _masks(weight, stretch) if weight < stretch else []
        whole = [np.any([patterns & (sum(1 << o for o in m) << at) == 0 for at in range(stretch - m[-1])], axis=0) for m in masks]
        left, chosen = np.ones(len(patterns), bool), []
        while left.any() and len(chosen) < FEW and masks:
            best = max(range(len(masks)), key=lambda i: int((whole[i] & left).sum()))
            chosen.append(masks[best])
            left &= ~whole[best]
        if not left.any():
            return tuple(chosen)
    return (tuple(range(max(1, -(-(stretch - spoiled) // (spoiled + 1))))),)  # too short for holes: a run that always agrees


def masks_for(size: int, window: int = WINDOW, share: float = SHARE) -> tuple[tuple[int, ...], ...]:
    """The masks of items of ``size`` tokens; items with equally many spoiled tokens share theirs."""
    size = min(size, window)
    spoiled = size - math.ceil(size * share)
    least = min(n for n in range(1, size + 1) if n - math.ceil(n * share) == spoiled) if spoiled else size
    return family(least, spoiled)


def _seeds(df: DataFrame, keep: list[str], position: str, masks: list[tuple[int, ...]], known: str | None) -> DataFrame:
    """One row per position and mask: ``keep``, ``position``, ``seed``. ``known``: list of the
    pair hashes that can stand at the ends of a seed."""
    if known is not None:
        df = df.withColumn("k", F.expr(f"transform(p, x -> x IN ({known}))"))
    at = []
    for mask in masks:
        span = mask[-1] + 1
        places = F.when(F.size("h") >= span, F.sequence(F.lit(0), F.size("h") - span)).otherwise(F.array().cast("array<int>"))
        ends = [o for o in sorted({0, span - 2}) if o in mask and o + 1 in mask] if known is not None else []
        if ends:
            places = F.filter(places, lambda i: F.get("k", i + ends[0]) & F.get("k", i + ends[-1]))
        name = F.lit(sum(1 << o for o in mask))
        at.append(F.transform(places, lambda i: F.struct(i.alias("at"), F.xxhash64(name, *[F.get("h", i + o) for o in mask]).alias("seed"))))
    if not at:
        at.append(F.array().cast("array<struct<at:int,seed:bigint>>"))
    return df.select(*keep, F.explode(F.concat(*at)).alias("s")).select(*keep, F.col("s.at").alias(position), "s.seed")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
             item_text: str = "text", window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """One row per document and item that overlap: ``id``, ``node``, ``item``, ``start`` (first aligned
    token of the document), ``aligned`` and ``matched`` tokens of the best alignment."""
    items = saved(_coded(benchmark.select(F.col(item_col).alias("item"), whole_text(item_text).alias("text")).distinct())
                  .filter(F.size("h") > 0).withColumn("key", F.xxhash64("h", "item")).drop("text"), "benchmark")
    families = [masks_for(n, window, share) for n in range(1, window + 1)]
    kinds = sorted(set(families))
    kind = F.get(F.array(*[F.lit(kinds.index(x)) for x in families]), F.least(F.size("h"), F.lit(window)) - 1)
    sized = items.select("key", "h", F.size("h").alias("size"), kind.alias("kind"))
    used = sorted(r[0] for r in sized.select("kind").distinct().collect())  # at most ``window`` numbers
    own = _seeds(sized.limit(0), ["key", "size"], "item_at", [], None)
    for k in used:
        own = own.unionByName(_seeds(sized.filter(F.col("kind") == k), ["key", "size"], "item_at", list(kinds[k]), None))
    masks = sorted({m for k in used for m in kinds[k]})
    own = saved(own, "benchmark-seeds")
    if own.count() <= BROADCAST_SEEDS:
        own = F.broadcast(own)
    pairs = [r[0] for r in items.select(F.explode("p")).distinct().limit(KNOWN_PAIRS + 1).collect()]  # bounded
    known = None if len(pairs) > KNOWN_PAIRS else ", ".join(f"{x}L" for x in pairs if x != -(1 << 63)) or "0L"

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), node_id(id_col, text).alias("node"), whole_text(text).alias("text"))
    hits = (_seeds(_coded(rows.select("node", "text")), ["node"], "doc_at", masks, known).join(own, "seed")
            .select("node", "key", "size", (F.col("doc_at") - F.col("item_at")).alias("diagonal")).distinct())
    hits = saved(hits.groupBy("node", F.floor(F.col("diagonal") / STRETCH)).agg(F.collect_list(F.struct("key", "size", "diagonal")).alias("hits")), "seed-hits")

    # the aligned part of a document and the item's hashes side by side
    def part(x: Column) -> Column:
        first, last = F.greatest(F.lit(0), -x["diagonal"]), F.least(x["size"], F.size("h") - x["diagonal"])
        said = F.slice("h", first + x["diagonal"] + 1, F.greatest(F.lit(0), last - first))
        return F.struct(x["key"].alias("key"), x["diagonal"].alias("diagonal"), first.alias("first"), last.alias("last"), said.alias("doc"))

    met = _coded(rows.join(hits, "node").select("id", "node", "text", "hits")).select("id", "node", F.explode(F.transform("hits", part)).alias("hit"))
    aligned = (met.select("id", "node", "hit.*").join(items.select("key", "item", F.col("h").alias("own")), "key").filter("last > first")
               .withColumn("same", F.transform(F.sequence(F.col("first"), F.col("last") - 1), lambda i: (
                   F.get("own", i) == F.get("doc", i - F.col("first"))).cast("int"))))
    stretch = F.least(F.size("own"), F.lit(window))
    ones = lambda i: F.aggregate(F.slice("same", i, stretch), F.lit(0), lambda a, x: a + x)
    begins = F.when(F.size("same") >= stretch, F.sequence(F.lit(1), F.size("same") - stretch + 1)).otherwise(F.array().cast("array<int>"))
    found = (aligned.filter(F.exists(begins, lambda i: ones(i) >= F.ceil(stretch * F.lit(share))))
             .withColumn("matched", F.aggregate("same", F.lit(0), lambda a, x: a + x)))
    best = F.max(F.struct("matched", F.size("same").alias("aligned"), (F.col("first") + F.col("diagonal")).alias("start"))).alias("b")
    return found.groupBy("node", "id", "item").agg(best).select("id", "node", "item", "b.start", "b.aligned", "b.matched")
