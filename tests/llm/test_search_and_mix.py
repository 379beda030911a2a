"""Source mixing, ranked search and hard negatives against brute force on small fixtures."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.llm import common, hard_negatives, mixing, ranked
from tests.llm.data import edge_docs, edge_rows, no_docs, sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def test_numbered(spark):
    rows = common.numbered(spark.range(1000).repartition(7).orderBy(F.desc("id")), "n").collect()
    assert sorted((r.n, r.id) for r in rows) == [(i, 999 - i) for i in range(1000)]
    assert common.numbered(spark.range(0), "n").count() == 0


# ---- 11 ---------------------------------------------------------------------
def _targets(sizes, epochs=3, weights=(1, 2, 3)):
    from fractions import Fraction
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        level = Fraction(total - sum(fixed.values()), sum(weight[s] for s in free) or 1)
        above = [s for s in free if level * weight[s] > epochs * sizes[s]]
        if not above:
            return {s: float(fixed.get(s, level * weight[s])) for s in order}
        fixed |= {s: epochs * sizes[s] for s in above}


def _mix_rows():
    rnd = random.Random(11)
    rows = [(i, sentence(rnd, rnd.choice((1, 3, 40, 400))), f"s{min(9, int(rnd.expovariate(0.4)))}") for i in range(600)]
    rows += [(1000 + i, sentence(rnd, 30), "hot") for i in range(500)] + [(5000, "same words here", "copies")] * 300
    rows += [(None, "nobody " * 7, None)] * 50 + [(None, None, None), (7000, None, "blank"), (7001, "  \n", "blank"), (7002, sentence(rnd, 30_000), "long")]
    return rows + [(7003, "\U0001f600 é", "é"), (7004, "x", "")]


@pytest.mark.parametrize("options", [{}, {"broadcast_sources": 3}, {"weights": (5, 1), "epochs": 2}])
def test_mix(spark, options):
    rows = _mix_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    docs = docs.withColumns({c: F.lit("x") for c in ("size", "target", "key", "draw", "words", "n", "number", "range", "place", "part", "id", "taken")})
    dealt = common.saved(mixing.mix(docs, **options), "dealt")
    got = dealt.collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORDS(t or ""))
    targets = _targets(sizes, options.get("epochs", 3), options.get("weights", (1, 2, 3)))
    assert sorted(map(str, ((r.id, r.text, r.source) for r in got))) == sorted(str((i, t or "", s)) for i, t, s in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(WORDS(r.text)) and r.taken == r.size * r.repeats and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-9) and 0 <= r.repeats <= options.get("epochs", 3)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= (15_000 if s == "long" else max(30, target / 50)), s
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(docs.repartition(3, "text"), with_text=False, **options).collect()
    key = lambda r: str((r.id, r.size, r.source_size, r.target, r.taken))
    assert sorted(map(key, again)) == sorted(map(key, got))
    texts = mixing.mixed_texts(dealt).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()
    assert {r.source: r.n for r in texts if r.n} == {s: n for s, n in taken.items() if n}


def test_mix_edges(spark):
    assert mixing.mix(no_docs(spark)).count() == 0
    assert Counter(r.id for r in mixing.mix(edge_docs(spark)).collect()) == Counter(r[0] for r in edge_rows())
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0)] * 2


# ---- 12 ---------------------------------------------------------------------
TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+").findall
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute_ranks(docs, items, k=10):
    own = [(d, Counter(TERMS((t or "").translate(LOWER)))) for d, t in docs]
    own = [(d, c) for d, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(TERMS((text or "").translate(LOWER)))
    out = set()
    for item, terms in asked.items():
        scored = []
        for d, c in own:
            m = 10 + 90 * sum(c.values()) * n // total
            scored.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c), d))
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out |= {(item, i + 1, d, s) for i, (s, d) in enumerate(best)}
    return out


@pytest.mark.parametrize("group,block", [(ranked.GROUP_ROWS, ranked.BLOCK_TERMS), (7, 40)])
def test_ranked_search(spark, group, block, monkeypatch):
    monkeypatch.setattr(ranked, "GROUP_ROWS", group)
    monkeypatch.setattr(ranked, "SLICE", 50)
    rnd = random.Random(12)
    word = lambda: f"w{int(rnd.expovariate(0.02))}"
    docs = [(i, " ".join(word() for _ in range(rnd.choice((1, 5, 80))))) for i in range(400)]
    docs += [(500 + i, "Tie of WORDS, é×É K") for i in range(30)] + [(None, "tie of words"), (None, "tie of words"), (7, docs[7][1]), (600, None), (601, " ,.\x00"), (602, "long " * 40_000)]
    items = [(i, " ".join(word() for _ in range(rnd.choice((1, 12, 40))))) for i in range(25)]
    items += [(100, "tie WORDS é×É"), (100, "of k"), (101, None), (102, "nowhere"), (103, ""), (None, "long tie"), (104, "K"), (3, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3).withColumns({c: F.lit("x") for c in ("doc", "terms", "item", "rank", "score")})
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit("x") for c in ("doc", "doc_id", "item", "term")})
    got = [(r.item, r.rank, r.doc, r.score) for r in ranked.search(d, b, block_terms=block).collect()]
    assert set(got) == _brute_ranks(docs, items) and len(got) == len(set(got))
    assert ranked.search(no_docs(spark), b).count() == 0 and ranked.search(d, b.limit(0)).count() == 0


def test_accumulators_are_limited():
    """A frequent term after a rare one opens no accumulators, yet adds to the open ones."""
    lengths, sizes = np.full(1000, 10), np.array([2] * 12 + [1] * 988)
    terms = np.array([0, 1] * 12 + [1] * 988)
    group = ranked.Group(lengths, terms, np.ones(len(terms), np.int64), sizes, 1000, 10_000)
    rows, scores = group.rank(np.array([0, 1]), np.array([5000, 1]), 10, 0)
    assert rows.tolist() == list(range(12)) and len(set(scores.tolist())) == 1
    assert scores[0] == 5001 * int(group.impact[0])
    assert len(group.rank(np.array([0, 1]), np.array([5000, 1]), 10, int(scores[0]) + 1)[0]) == 0


# ---- 13 ---------------------------------------------------------------------
def _brute_negatives(rows, every=100):
    own = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, [math.floor(256 * float(x)) for x in v], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, va, la in own:
        if a is None or a % every:
            continue
        scored = [x for x in ((dot(va, v), i, label) for i, v, label in own) if -2 ** 63 <= x[0] < 2 ** 63]
        for s, p, _ in sorted((x for x in scored if x[2] == la and x[1] != a), key=order)[:5]:
            inside = sorted((x for x in scored if x[2] != la and 80 * s <= 100 * x[0] <= 100 * s), key=order)[:5]
            out += [(a, p, j + 1, x[1], s, x[0]) for j, x in enumerate(inside)]
    return Counter(out)


def _vectors(scale=1.0, n=900):
    rnd = np.random.default_rng(13)
    centre = rnd.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in scale * (centre[i % 6] + rnd.normal(size=8))], int(rnd.integers(4))) for i in range(n)]
    hot = rows[0][1]
    rows += [(2000 + i, hot, i % 3) for i in range(150)]  # one common vector
    rows += [(3000, None, 1), (3100, [1.0, None], 1), (3200, [float("nan")] * 8, 1), (3300, [float("inf")] + [0.0] * 7, 2), (3400, hot, None)]
    return rows + [(None, hot, 1), (None, hot, 2), (100, rows[100][1], rows[100][2]), (3500, [], 1), (3600, hot[:3], 1), (3700, [0.0] * 8, 2), (3800, hot, -3)]


@pytest.mark.parametrize("scale,block", [(1.0, 4096), (1.0, 4), (1e5, 4096), (1e7, 4096)])
def test_hard_negatives(spark, scale, block, monkeypatch):
    for name, small in (("LEAF_ROWS", 8), ("TILE_ROWS", 100), ("FANOUT", 3), ("TREE_PAGES", 30)):
        monkeypatch.setattr(hard_negatives, name, small)
    rows = _vectors(scale)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    table = table.withColumns({c: F.lit("x") for c in ("id", "v", "row", "number", "score", "place", "anchor", "cells", "ids")})
    got = hard_negatives.mine(table, anchor_block=block).collect()
    assert Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got) == _brute_negatives(rows)


def test_hard_negative_edges(spark):
    table = spark.createDataFrame(_vectors(n=10), "vec_id bigint, embedding array<double>, label int")
    assert hard_negatives.mine(table.limit(0)).count() == 0 and hard_negatives.mine(table.filter("vec_id % 100 <> 0")).count() == 0
    huge = spark.createDataFrame([(0, [1e300, 1.0], 1), (1, [1e300, 0.0], 1), (2, [1e299, 0.0], 2), (3, [1e300, 3.0], 2), (5, [1e308, 3.0], 2)], "vec_id bigint, embedding array<double>, label int")
    assert hard_negatives.mine(huge).count() == 0  # scores beyond 64 bits


def test_pages_hold_all_rows_and_prune(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    v = np.floor(256 * (rnd.integers(0, 10, (3000, 1)) * 4 + rnd.normal(size=(3000, 2))))
    pages = list(hard_negatives.tiles(v, np.arange(3000), np.array([0, 1])))
    assert sorted(np.concatenate(pages)) == list(range(3000)) and max(map(len, pages)) <= hard_negatives.LEAF_ROWS
    made = [{"dims": 2, "ids": p.tolist(), "cells": v[p].tobytes(), "low": v[p].min(axis=0).tobytes(), "high": v[p].max(axis=0).tobytes()} for p in pages]
    tree, opened = hard_negatives.Tree(made, 2, True), []
    add = hard_negatives.Best.add
    monkeypatch.setattr(hard_negatives.Best, "add", lambda self, *a: (opened.append(1), add(self, *a)))
    best = hard_negatives.Best(5, -np.inf, np.inf)
    hard_negatives.explore([tree], v[0], [best])
    assert [s for s, _ in best.top] == sorted((int(x) for x in v @ v[0]), reverse=True)[:5] and len(opened) < len(pages) / 5
