"""Substring deduplication with repeated-phrase automata.

A word is removed when a window of 35 consecutive words that covers it also
starts anywhere else (in another document or further on in the same one).

1. Anchors. Every window of 35 words names one anchor: the 12-word run in it
   with the smallest hash (leftmost on ties). Equal windows name equal anchors,
   so a window recurs only if its anchor is named from two places; anchors take
   a tenth of the space of the windows. Anchors named once are dropped.
2. Candidates. The windows whose anchor recurs are counted by hash. From
   those that start twice or more come the passages to look for: in the document
   with the smallest id that has it, a run of such windows goes on while
   all occurrences of one window are followed by the next one, both occur
   equally often and their anchors belong to one shard.
3. Automata. An anchor's home is the smallest document id that names it, and a
   shard holds the passages of a range of homes. Each shard's passages are
   compiled into Aho-Corasick automata over word numbers, and of every document
   the stretches whose windows name an anchor of the shard are streamed through
   (a passage occurs nowhere else). The number of shards
   grows with the text; a shard whose stretches exceed ``GROUP_BYTES`` is dealt
   into several groups by document, each with the shard's passages, and a
   group's automata hold ``AUTOMATON_WORDS`` words at most at a time.
4. Confirmation. A hit is an exact comparison of all words. The hits of a passage
   are added up over all documents, and only passages hit twice or more are
   cut. If a passage is not hit as often as its hashes said, these were shared by
   different windows: all texts of its windows are then looked for one by one.
5. The spans found are united per document and cut out.

So hashes only say what to look for.

NULL and empty texts have no words; texts of fewer than 35 words stay whole.
Rows with one id are told apart by their texts; identical rows repeat each
other and lose all words if they have 35 or more. Extra columns are ignored,
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm import words
from staylake.llm.common import node_id, saved, ship, whole_text

WINDOW, ANCHOR = 35, 12
GROUP_BYTES = 8 << 20
AUTOMATON_WORDS = 500_000
ANCHOR_BYTES = 100  # text that an anchor that recurs adds to a stretch, about
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def anchored(w: words.Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per window: first word, hash, and the hash and first word of its anchor."""
    at, h = w.windows(window)
    n = len(w.hashes)
    first, gram = w.windows(anchor)
    low, place = np.full(n, TOP), np.arange(n)
    low[first] = gram
    need, have = window - anchor + 1, 1
    while have < need:  # minima over `have` runs from each word, grown by as much as fits
        step = min(have, need - have)
        right, right_place = np.full(n, TOP), np.arange(n)
        rest = max(0, n - step)
        right[:rest], right_place[:rest] = low[n - rest:], place[n - rest:]
        less = right < low
        low, place = np.where(less, right, low), np.where(less, right_place, place)
        have += step
    return at, h, low[at], place[at]


def _hex_sha256(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[offsets[i]:offsets[i + 1]]).hexdigest() for i in range(len(offsets) - 1)]


def _survey(window: int, anchor: int):
    def run(batches):
        for part, w in words.parsed_slices(batches, "text"):
            at, _, low, place = anchored(w, window, anchor)
            place, once = np.unique(place, return_index=True)
            names = low[once].view(np.int64)
            cut = np.searchsorted(place, w.first)
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(names))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(w.counts.astype(np.int64)), pa.array(_hex_sha256(*words.joined(w))), lists],
                names=["doc", "node", "version", "n_words", "kept_sha256", "anchors"])
    return run


def _lookup(lists: pa.Array, *fields: str) -> list[np.ndarray]:
    """The struct fields of all lists together, sorted by the first one and without repeats of it."""
    flat = lists.flatten()
    cols = [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]
    key, at = np.unique(cols[0], return_index=True)
    return [key, *[c[at] for c in cols[1:]]]


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


def _shard(home: np.ndarray, shards: int) -> np.ndarray:
    return (words.mix(home.view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _windows(window: int, anchor: int, bits: int):
    """(hash, next window's hash or 0, node) of every window whose anchor recurs."""
    def run(batches):
        for part, w in words.parsed_slices(batches, "text"):
            at, h, low, _ = anchored(w, window, anchor)
            h >>= np.uint64(64 - bits)
            keys, _ = _lookup(part.column(part.schema.get_field_index("anchors")), "anchor", "home")
            _, ok = _find(keys, low.view(np.int64))
            following = np.zeros(len(h), np.uint64)
            if len(h):
                following[:-1] = np.where(at[1:] == at[:-1] + 1, h[1:], 0)
            doc = np.searchsorted(w.first, at, side="right") - 1
            node = part.column(part.schema.get_field_index("node")).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (h.view(np.int64), following.view(np.int64), node[doc])], names=["h", "following", "node"])
    return run


def _passages(window: int, anchor: int, bits: int, shards: int, single: bool):
    """The passages to look for whose home is the document: their shard, text, window hashes and how often
    those say they occur. ``single``: every window by itself, whatever its home."""
    def run(batches):
        for part, w in words.parsed_slices(batches, "text"):
            at, h, low, _ = anchored(w, window, anchor)
            h >>= np.uint64(64 - bits)
            col = lambda name: part.column(part.schema.get_field_index(name))
            keys, times, following, home = _lookup(col("confirmed"), "h", "times", "following", "home")
            i, ok = _find(keys, h.view(np.int64))
            names, homes = _lookup(col("anchors"), "anchor", "home")
            j, named = _find(names, low.view(np.int64))
            ok &= named
            if not ok.any():
                continue
            shard = _shard(homes[j], shards)
            on = np.zeros(len(h), bool)  # the window goes on into the next one
            if not single:
                doc = np.searchsorted(w.first, at, side="right") - 1
                ok &= home[i] == col("node").to_numpy()[doc]
                on[:-1] = (ok[:-1] & ok[1:] & (at[1:] == at[:-1] + 1) & (following[i[:-1]] != 0) & (shard[:-1] == shard[1:])
                           & (following[i[:-1]] == h.view(np.int64)[1:]) & (times[i[:-1]] == times[i[1:]]))
            begin = ok.copy()
            begin[1:] &= ~on[:-1]
            a, z = np.flatnonzero(begin), np.flatnonzero(ok & ~on)
            data = w.data.tobytes()
            text = [b" ".join(data[w.starts[k]:w.ends[k]] for k in range(at[s], at[e] + window)).decode() for s, e in zip(a, z)]
            hashes = [h.view(np.int64)[s:e + 1] for s, e in zip(a, z)]
            yield pa.RecordBatch.from_arrays([pa.array(shard[a]), pa.array(text, pa.string()), pa.array(times[i[a]]), pa.array(hashes, pa.list_(pa.int64()))],
                                             names=["shard", "passage", "times", "hashes"])
    return run


def _stretches(window: int, anchor: int, shards: int):
    """Of every document and shard the stretches covered by windows that name an anchor of the shard."""
    def run(batches):
        for part, w in words.parsed_slices(batches, "text"):
            at, _, low, _ = anchored(w, window, anchor)
            col = lambda name: part.column(part.schema.get_field_index(name))
            names, homes = _lookup(col("anchors"), "anchor", "home")
            j, ok = _find(names, low.view(np.int64))
            if not ok.any():
                continue
            at, shard = at[ok], _shard(homes[j[ok]], shards)
            doc = np.searchsorted(w.first, at, side="right") - 1
            order = np.lexsort((at, shard, doc))
            at, shard, doc = at[order], shard[order], doc[order]
            apart = (doc[1:] != doc[:-1]) | (shard[1:] != shard[:-1]) | (at[1:] > at[:-1] + window)
            a, z = np.concatenate([[0], np.flatnonzero(apart) + 1]), np.concatenate([np.flatnonzero(apart), [len(at) - 1]])
            data = w.data.tobytes()
            text = [data[w.starts[at[s]]:w.ends[at[e] + window - 1]].decode() for s, e in zip(a, z)]
            own = doc[a]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[a]), col("node").take(pa.array(own)), col("version").take(pa.array(own)), pa.array((at[a] - w.first[own]).astype(np.int64)),
                 pa.array(text, pa.string())], names=["shard", "node", "version", "begin", "text"])
    return run


def locate(texts: list[str], passages: list[str], most_words: int = AUTOMATON_WORDS) -> list[list[tuple[int, int, int]]]:
    """All occurrences of the passages in each text: first word, word after the last, number of the passage.

    Passages are compiled into one automaton after another, of about
    ``most_words`` words each; every text is run through each of them.
    """
    number: dict[str, int] = {}
    split = re.compile(r"[^\x20\x09-\x0D]+").findall
    coded = [tuple(number.setdefault(x, len(number) + 1) for x in p.split(" ")) for p in passages]
    streams = [tuple(number.get(x, 0) for x in split(t)) for t in texts]
    hits: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    begin = 0
    while begin < len(coded):
        automaton, held = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE), 0
        while begin < len(coded) and (not held or held + len(coded[begin]) <= most_words):
            automaton.add_word(coded[begin], begin)
            held += len(coded[begin])
            begin += 1
        automaton.make_automaton()
        for i, stream in enumerate(streams):
            hits[i] += [(end + 1 - len(coded[p]), end + 1, p) for end, p in automaton.iter(stream)]
    return hits


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


FOUND = "node bigint, version bigint, passage bigint, hits bigint, spans array<int>"


def _scan(key, docs: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
    """Spans of passages hit twice or more in this group, united per stretch; spans of those hit once, which
    another group may hit too, under their passage; and the hits of every passage."""
    found = locate(docs.text.tolist(), passages.passage.tolist())
    copies, begin = docs.copies.tolist(), docs.begin.tolist()
    hits = np.zeros(len(passages), np.int64)
    for n, own in zip(copies, found):
        for _, _, p in own:
            hits[p] += n
    number, node, version = passages.number.tolist(), docs.node.tolist(), docs.version.tolist()
    out = [(None, None, number[p], int(hits[p]), []) for p in np.flatnonzero(hits)]
    for i, own in enumerate(found):
        sure = united([(a, z) for a, z, p in own if hits[p] > 1])
        if sure:
            out.append((node[i], version[i], None, None, [x + begin[i] for s in sure for x in s]))
        out += [(node[i], version[i], number[p], None, [a + begin[i], z + begin[i]]) for a, z, p in own if hits[p] == 1]
    cols = [list(c) for c in zip(*out)] or [[]] * 5
    whole = {c: pd.array(x, "Int64") for c, x in zip(("node", "version", "passage", "hits"), cols)}
    return pd.DataFrame({**whole, "spans": pd.Series(cols[4], dtype=object)})


def _cut(batches):
    for part, w in words.parsed_slices(batches, "text"):
        col = lambda name: part.column(part.schema.get_field_index(name))
        depth = np.zeros(len(w.hashes) + 1, np.int64)
        for i, lists in enumerate(col("spans").to_pylist()):
            for spans in lists or ():
                for a, z in zip(spans[::2], spans[1::2]):
                    depth[w.first[i] + a] += 1
                    depth[w.first[i] + z] -= 1
        keep = np.cumsum(depth[:-1]) == 0
        data, off = words.joined(w, keep)
        kept = np.diff(np.concatenate([[0], np.cumsum(keep)])[w.first])
        yield pa.RecordBatch.from_arrays(
            [col("node"), col("version"), pa.array((w.counts - kept).astype(np.int64)), pa.array(_hex_sha256(data, off)),
             pa.array([data[off[i]:off[i + 1]].tobytes().decode() for i in range(part.num_rows)], pa.string())],
            names=["node", "version", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_text: bool = True,
                   group_bytes: int = GROUP_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_removed``, ``kept_sha256`` and, where words
    were removed, ``kept_text`` (NULL elsewhere: the text stays as it is). ``hash_bits`` is lowered in tests only."""
    ship("staylake.llm.words", "staylake.llm.repeats")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), node_id(id_col, text).alias("node"),
                       F.xxhash64(whole_text(text)).alias("version"), whole_text(text).alias("text"))
    survey = saved(rows.mapInArrow(_survey(WINDOW, ANCHOR), "doc bigint, node bigint, version bigint, n_words bigint, kept_sha256 string, anchors array<bigint>"), "survey")

    named = survey.select("node", F.explode("anchors").alias("anchor"))
    # written, so that the join back is planned from its size, and a very common anchor's rows can be split
    recurring = saved(named.groupBy("anchor").agg(F.count("*").alias("times"), F.min("node").alias("home")).filter("times > 1").drop("times"), "anchors")
    of_doc = (named.join(recurring, "anchor").groupBy("node")
              .agg(F.collect_set(F.struct("anchor", "home")).alias("anchors")))
    candidates = saved(rows.select("node", "version", "text").join(of_doc, "node"), "candidates")
    shards = max(1, int((candidates.agg(F.sum(F.size("anchors"))).first()[0] or 0) * ANCHOR_BYTES // group_bytes))

    windows = candidates.select("node", "anchors", "text").mapInArrow(_windows(WINDOW, ANCHOR, hash_bits), "h bigint, following bigint, node bigint")
    confirmed = (windows.groupBy("h")
                 .agg(F.count("*").alias("times"), F.min("following").alias("a"), F.max("following").alias("z"), F.min("node").alias("home"))
                 .filter("times > 1")
                 .select("h", "times", F.when(F.col("a") == F.col("z"), F.col("a")).otherwise(F.lit(0)).alias("following"), "home"))

    def passages_of(told: DataFrame, single: bool) -> DataFrame:
        """``told``: a node and the hashes of windows to take from its text."""
        own = told.groupBy("node").agg(F.collect_set(F.struct("h", "times", "following", "home")).alias("confirmed"))
        found = (candidates.select("node", "anchors", "text").join(own, "node").select("node", "anchors", "confirmed", "text")
                 .mapInArrow(_passages(WINDOW, ANCHOR, hash_bits, shards, single), "shard bigint, passage string, times bigint, hashes array<bigint>"))
        found = found.groupBy("shard", "passage").agg(F.first("times").alias("times"), F.first("hashes").alias("hashes"))
        return saved(found.withColumn("number", F.monotonically_increasing_id()), "passages")

    cut_out = candidates.select("node", "version", "anchors", "text").mapInArrow(_stretches(WINDOW, ANCHOR, shards), "shard bigint, node bigint, version bigint, begin bigint, text string")

    def spans_of(passages: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The spans to cut, and how often each passage was hit."""
        streams = (cut_out.join(passages.select("shard").distinct(), "shard", "left_semi").groupBy("shard", "node", "version", "begin")
                   .agg(F.first("text").alias("text"), F.count("*").alias("copies")))  # rows equal in id and text are streamed once
        streams = saved(streams, "stretches")
        weight = saved(streams.groupBy("shard").agg(F.ceil(F.sum(F.length("text") + 64) / group_bytes).cast("int").alias("groups")), "shards")
        dealt = streams.join(weight, "shard").withColumn("part", F.pmod(F.xxhash64("node", "version", "begin"), F.col("groups")).cast("int")).drop("groups")
        compiled = (passages.select("shard", "passage", "number").join(weight, "shard")
                    .select("shard", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), "passage", "number"))
        found = saved(dealt.groupBy("shard", "part").cogroup(compiled.groupBy("shard", "part")).applyInPandas(_scan, FOUND), "hits")
        hits = saved(found.filter("hits IS NOT NULL").groupBy(F.col("passage").alias("number")).agg(F.sum("hits").alias("hits")), "hits")
        single = found.filter("hits IS NULL AND passage IS NOT NULL").join(hits.filter("hits > 1").select(F.col("number").alias("passage")), "passage", "left_semi")
        return found.filter("passage IS NULL").unionByName(single.select(*found.columns)).select("node", "version", "spans"), hits

    passages = passages_of(confirmed.select(F.col("home").alias("node"), "h", "times", "following", "home"), False)
    spans, hits = spans_of(passages)
    missed = saved(passages.join(hits, "number", "left").filter(F.coalesce("hits", F.lit(0)) != F.col("times"))
                   .select(F.explode("hashes").alias("h")).distinct(), "shared-hashes")
    if not missed.isEmpty():
        told = (windows.join(missed, "h").select("node", "h", F.lit(0).cast("bigint").alias("times"), F.lit(0).cast("bigint").alias("following"),
                                                 F.lit(0).cast("bigint").alias("home")))
        spans = spans.unionByName(spans_of(passages_of(told, True))[0])
    per_doc = spans.groupBy("node", "version").agg(F.collect_list("spans").alias("spans"))
    cut = (candidates.select("node", "version", "text").join(per_doc, ["node", "version"]).select("node", "version", "spans", "text")
           .mapInArrow(_cut, "node bigint, version bigint, n_removed bigint, kept_sha256 string, kept_text string"))
    if not with_text:
        cut = cut.drop("kept_text")
    cut = saved(cut.withColumnRenamed("kept_sha256", "cut_sha256").dropDuplicates(["node", "version"]), "cut")
    return (survey.drop("anchors").join(cut, ["node", "version"], "left")
            .withColumns({"n_removed": F.coalesce("n_removed", F.lit(0).cast("bigint")), "kept_sha256": F.coalesce("cut_sha256", "kept_sha256")})
            .select(F.col("doc").alias("id"), "n_words", "n_removed", "kept_sha256", *(["kept_text"] if with_text else [])))
