"""Mixing sources to target weights by capped water-filling, and a seeded sample that meets the targets.

All sources together keep the words they have. Each source's share is in
proportion to its weight, but never more than ``epochs`` times its own words: a
source above that is clamped, and what it leaves is dealt again by weight, until
none is above. The water level (words per unit of weight) is kept as a fraction
of two integers, so nothing is rounded on the way; a round costs one aggregate
over the sources and returns two numbers. The level only rises, so rounds end.

A target of w whole repetitions and a rest takes every document w times. The rest
is taken from the documents in the order of a seeded draw (a digest of seed, id
and text): sums per range of draws find the range in which the rest is reached, in
that range finer sums, and there the document at which it is reached. So no
documents are sorted or moved, and a source of any size costs a few thousand
sums. What is still missing then (less than that document) is filled up by up to
``FILLS`` single documents of those left: the largest that fits, again and again,
ended at any point by the one whose size comes nearest, whichever of these comes
nearest in all. Sources of a few documents cannot always come close; one with a
single document can only be taken a whole number of times.

Only DataFrame functions are used. Sources are joined by broadcast if they are
counted to be at most ``broadcast_sources``; beyond, the join is salted, since
one source may hold a third of all rows.

NULL and empty texts have size 0 and are in the mix with 0 words. A NULL source
is a source of its own, last in order. Sources without words get the target 0.
Rows equal in id and text have one draw; if only some copies are taken, they are
numbered by their place in a written table, and which ones are marked is not
defined (their sum is). Very long texts are counted whole. Extra columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm.common import numbered, saved, whole_text

EPOCHS, WEIGHTS, SEED = 3, (1, 2, 3), "mix"
BROADCAST_SOURCES, SALTS = 100_000, 32
DRAW_BITS, LEVEL_BITS = 60, 10
FILLS = 4


def _sized(docs: DataFrame, seed: str, id_col: str) -> DataFrame:
    text, mark = whole_text(), F.lit("\x1f")
    name = F.concat(F.lit(seed), mark, F.coalesce(F.col(id_col).cast("string"), F.lit("")), mark, text)
    return docs.select(F.col(id_col).alias("id"), F.col("source").cast("string").alias("source"), text.alias("text"),
                       F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
                       F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"),
                       F.conv(F.substring(F.md5(name), 1, DRAW_BITS // 4), 16, 10).cast("bigint").alias("draw"))


def _big(value: Column | int) -> Column:
    return (F.lit(value) if isinstance(value, int) else value).cast("decimal(19,0)")


def water_fill(sources: DataFrame, epochs: int) -> DataFrame:
    """Adds ``target``, the ``whole`` repetitions and the words still to ``need`` to sources with ``words`` and ``weight``."""
    cap = F.col("words") * epochs
    level, weights = sources.agg(F.sum("words"), F.sum("weight")).first()
    total = level
    while True:
        above = _big(cap) * _big(weights or 0) < _big(level or 0) * _big(F.col("weight"))
        clamped, free = sources.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if (total or 0) - (clamped or 0) == (level or 0) and free == weights:
            break
        level, weights = total - clamped, free
    asked, unit = _big(level or 0) * _big(F.col("weight")), _big(weights or 0)
    own = sources.select("*", above.alias("above"), asked.alias("asked"), (unit * _big(F.col("words"))).alias("unit_words"), unit.alias("unit"))
    own = own.withColumn("whole", F.expr(f"CASE WHEN above THEN {epochs} WHEN words = 0 THEN 0 ELSE asked div unit_words END").cast("bigint"))
    return own.select(*sources.columns, "whole",
                      F.when(F.col("above"), cap.cast("double")).otherwise(F.lit(float(level or 0)) * F.col("weight") / F.lit(float(weights or 1))).alias("target"),
                      F.expr("CASE WHEN above OR words = 0 THEN 0 ELSE (2 * (asked - whole * unit_words) + unit) div (2 * unit) END").cast("bigint").alias("need"))


def _joined(rows: DataFrame, sources: DataFrame, bound: int, narrow: bool) -> DataFrame:
    """Rows with their source's columns. ``narrow``: the sources are counted to be at most ``bound``."""
    if narrow:
        return rows.join(F.broadcast(sources), "key")
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod("draw", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"]).drop("salt")


def _reached(sums: DataFrame, unit: str) -> DataFrame:
    """Per source the first ``unit`` at which its running sum reaches ``need``, and the sum before it."""
    w = Window.partitionBy("key").orderBy(unit)
    run = sums.withColumn("upto", F.sum("words").over(w)).filter("upto >= need")
    return run.withColumn("first", F.row_number().over(w)).filter("first = 1").withColumn("need", F.col("need") - F.col("upto") + F.col("words"))


@dataclass
class Mix:
    """Targets per source and how its documents meet them."""

    rows: DataFrame        # id, source, key, size, draw
    sources: DataFrame     # key, source, words, weight, whole, target, need, at, at_copies, extras
    bound: int
    narrow: bool

    def deal(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their source's target and their number of repetitions."""
        full = _joined(rows, self.sources.select("key", "words", "whole", "target", "at", "at_copies", "extras"), self.bound, self.narrow)
        extra = F.coalesce(F.array_contains("extras", F.col("draw")), F.lit(False))
        edge = extra | F.coalesce(F.col("draw") == F.col("at"), F.lit(False))
        inner = full.filter(~edge).withColumn("more", F.coalesce((F.col("draw") < F.col("at")).cast("bigint"), F.lit(0)))
        placed = saved(full.filter(edge).withColumn("place", F.monotonically_increasing_id()), "mix-edge").withColumn("part", F.shiftright("place", 33))
        same = Window.partitionBy("key", "draw")
        parts = (placed.groupBy("key", "draw", "part").agg(F.count("*").alias("n")).withColumn(
            "before", F.coalesce(F.sum("n").over(same.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n"))
        allowed = F.when(F.col("draw") == F.col("at"), F.col("at_copies")).otherwise(0) + F.when(extra, 1).otherwise(0)
        copy = F.row_number().over(Window.partitionBy("part", "key", "draw").orderBy("place")) + F.col("before")
        edges = placed.join(parts, ["key", "draw", "part"]).withColumn("more", (copy <= allowed).cast("bigint"))
        out = inner.select(*rows.columns, "words", "target", "whole", "more").unionByName(edges.select(*rows.columns, "words", "target", "whole", "more"))
        return (out.withColumn("repeats", F.col("whole") + F.col("more")).withColumn("taken", F.col("size") * F.col("repeats"))
                .withColumnRenamed("words", "source_size").drop("whole", "more", "key", "draw"))


def plan(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, id_col: str = "doc_id",
         broadcast_sources: int = BROADCAST_SOURCES) -> Mix:
    if epochs < 1:
        raise ValueError("targets cannot be met with less than one repetition")
    rows = saved(_sized(docs, seed, id_col).drop("text"), "mix-rows")
    found = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("words")).orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.pmod("number", F.lit(len(weights))) + 1).cast("int"))
    sources = saved(numbered(found, "number").withColumn("weight", turn).drop("number"), "mix-sources")
    narrow = sources.limit(broadcast_sources + 1).count() <= broadcast_sources
    sources = saved(water_fill(sources, epochs), "mix-targets")

    join = lambda state: _joined(rows, state, broadcast_sources, narrow)
    state = sources.filter("need > 0").select("key", "need")
    for shift in (DRAW_BITS - LEVEL_BITS, DRAW_BITS - 2 * LEVEL_BITS):  # ranges of draws, then ranges within
        inside = join(state)
        if "range" in state.columns:
            inside = inside.filter(F.shiftright("draw", shift + LEVEL_BITS) == F.col("range"))
        sums = inside.groupBy("key", "need", F.shiftright("draw", shift).alias("at_range")).agg(F.sum("size").alias("words"))
        state = saved(_reached(sums, "at_range").select("key", "need", F.col("at_range").alias("range")), "mix-range")
    last = join(state).filter(F.shiftright("draw", DRAW_BITS - 2 * LEVEL_BITS) == F.col("range"))
    last = _reached(last.groupBy("key", "need", "draw").agg(F.sum("size").alias("words"), F.count("*").alias("copies")), "draw")
    size = F.expr("words div copies")
    last = saved(last.select("key", F.col("draw").alias("at"), "copies", F.expr("need div (words div copies)").alias("at_copies"),
                             (F.col("need") % size).alias("left")), "mix-last")
    state = last.withColumns({"filled": F.expr("CAST(array() AS array<bigint>)"), "extras": F.expr("CAST(array() AS array<bigint>)"), "miss": F.col("left")})
    for _ in range(FILLS):
        free = join(state.filter("left > 0")).filter("(draw > at OR (draw = at AND at_copies < copies)) AND NOT array_contains(filled, draw)")
        off = F.abs(F.col("size") - F.col("left"))
        best = free.filter(off < F.col("left")).groupBy("key").agg(  # documents that would bring the source nearer
            F.min(F.struct(off.alias("miss"), "draw")).alias("near"), F.min(F.when(F.col("size") <= F.col("left"), F.struct(off.alias("miss"), "draw"))).alias("fit"))
        nearer = F.coalesce(F.col("near.miss") < F.col("miss"), F.lit(False))
        state = saved(state.join(best, "key", "left").select(
            "key", "at", "copies", "at_copies", F.coalesce("fit.miss", F.lit(0)).alias("left"),
            F.when(nearer, F.col("near.miss")).otherwise(F.col("miss")).alias("miss"),
            F.when(nearer, F.concat("filled", F.array("near.draw"))).otherwise(F.col("extras")).alias("extras"),
            F.when(F.col("fit").isNull(), F.col("filled")).otherwise(F.concat("filled", F.array("fit.draw"))).alias("filled")), "mix-fill")
    whole = sources.join(state.select("key", "at", "at_copies", "extras"), "key", "left")
    return Mix(rows, saved(whole, "mix-plan"), broadcast_sources, narrow)


def mix(docs: DataFrame, with_text: bool = True, **options) -> DataFrame:
    """Each document with its size, its source's size and target, how often it is repeated and the words that gives."""
    made = plan(docs, **options)
    if not with_text:
        return made.deal(made.rows)
    return made.deal(_sized(docs, options.get("seed", SEED), options.get("id_col", "doc_id")))


def mixed_texts(dealt: DataFrame) -> DataFrame:
    """The mix itself: a row per repetition."""
    return dealt.filter("repeats > 0").select("id", "source", "text", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("epoch"))
