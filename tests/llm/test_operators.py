"""The ten operators against brute force on small fixtures."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylake.llm import (chat, decontaminate, encode, exact_dedup, licenses, near_dup, packing, queries, records, repeats,
                          toxicity, url_rules)
from staylake.session import scratch_path
from tests.llm.data import edge_docs, edge_rows, no_docs, sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
LOWER = str.maketrans(exact_dedup.UPPER, exact_dedup.LOWER)


# ---- 1 ----------------------------------------------------------------------
def _brute_overlaps(docs, items):
    split = lambda t: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    out = set()
    for i, (doc, text) in enumerate(docs):
        d = split(text)
        for item, own in items:
            b = split(own)
            if not b:
                continue
            size = min(20, len(b))
            for g in range(-len(b) + 1, len(d)):
                same = [d[g + k] == b[k] for k in range(max(0, -g), min(len(b), len(d) - g))]
                if any(sum(same[a:a + size]) >= -(-size * 8 // 10) for a in range(len(same) - size + 1)):
                    out.add((doc, item))
    return out


def test_decontamination(spark):
    import random
    rnd = random.Random(1)
    items = [(i, sentence(rnd, 30)) for i in range(6)] + [(6, "tiny one here"), (7, None), (8, ""), (8, sentence(rnd, 25))]
    docs = [(100 + i, sentence(rnd, 40)) for i in range(10)]
    for i in range(4):  # whole, with substitutions, cut, short
        w = items[i][1].split(" ")
        if i == 1:
            w[5], w[17] = "x", "y"
        docs.append((200 + i, sentence(rnd, 15) + ", " + " ".join(w[:22] if i == 2 else w).upper() + ". " + sentence(rnd, 9)))
    docs += [(300, "say tiny one here now"), (301, None), (302, ""), (None, items[0][1]), (200, docs[10][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("node", "h", "p", "item", "key")})
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumns({c: F.lit("x") for c in ("key", "h", "doc_id")})
    found = decontaminate.overlaps(d, b)
    got = {(r.id, r.item) for r in found.collect()}
    assert got == _brute_overlaps(docs, items) and {(201, 1), (202, 2), (300, 6), (None, 0)} <= got
    assert decontaminate.overlaps(d.limit(0), b).count() == 0 and decontaminate.overlaps(d, b.limit(0)).count() == 0


def test_every_accepted_pattern_has_a_seed():
    from itertools import combinations
    for window in (20, 30):
        for size in range(1, window + 1):
            m, masks = size - -(-size * 8 // 10), decontaminate.masks_for(size, window)
            assert len(masks) <= 4 and all(len(x) == size or len(x) <= 7 for x in masks)
            if size >= 5:
                assert all(len(x) < x[-1] + 1 for x in masks)  # spaced: every mask has holes
            if window == 20:
                places = [sum(1 << o for o in x) << at for x in masks for at in range(size - x[-1])]
                for spoiled in combinations(range(size), m):
                    bits = sum(1 << p for p in spoiled)
                    assert any(not p & bits for p in places)


def test_decontamination_spread_substitutions(spark):
    import random
    rnd = random.Random(4)
    items, docs = [], []
    for n in [*range(1, 25), 40]:
        items.append((n, sentence(rnd, n, 10 ** 6)))
        size = min(20, n)
        m = size - -(-size * 8 // 10)
        for extra in (0, 1):  # as many as are accepted, spread evenly, and one more
            w = items[-1][1].split(" ")
            if m + extra:
                for j in range(m + extra):
                    w[min(n - 1, (2 * j + 1) * size // (2 * (m + extra)))] = "other"
            if n == 40:
                w[20:] = ["other"] * 20
            docs.append((100 * n + extra, sentence(rnd, 9) + " " + " ".join(w) + " " + sentence(rnd, 9)))
    found = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.id, r.item) for r in found.collect()}
    assert got == _brute_overlaps(docs, items) and {(100 * n, n) for n, _ in items} <= got


# ---- 2 ----------------------------------------------------------------------
def _brute_repeats(texts, k=35):
    docs = [WORDS(t or "") for t in texts]
    seen = Counter(tuple(d[i:i + k]) for d in docs for i in range(len(d) - k + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - k + 1):
            if seen[tuple(d[i:i + k])] > 1:
                gone[i:i + k] = [True] * k
        out.append((len(d), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(d, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("group_bytes", [repeats.GROUP_BYTES, 500])
def test_repeats(spark, group_bytes):
    rows = edge_rows()
    got = repeats.remove_repeats(edge_docs(spark), group_bytes=group_bytes).collect()
    expected = [(r[0], *x) for r, x in zip(rows, _brute_repeats([r[1] for r in rows]))]
    assert sorted(map(str, expected)) == sorted(str((r.id, r.n_words, r.n_removed, r.kept_sha256)) for r in got)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got if r.n_removed)
    assert repeats.remove_repeats(no_docs(spark)).count() == 0


def test_locate_splits_automata():
    text, passages = "a b c d e f g", ["b c d", "d e", "g"]
    for most in (1, 4, 100):
        found = repeats.locate([text, "x"], passages, most)
        assert [sorted(x) for x in found] == [[(1, 4, 0), (3, 5, 1), (6, 7, 2)], []] and repeats.united([x[:2] for x in found[0]]) == [(1, 5), (6, 7)]


@pytest.mark.parametrize("bits,group_bytes", [(12, repeats.GROUP_BYTES), (14, 3000)])
def test_repeats_are_confirmed_whatever_the_hashes_say(spark, bits, group_bytes):
    """Short hashes: different windows share them, yet only what occurs twice is cut, and all of that."""
    import random
    rnd = random.Random(15)
    shared = [sentence(rnd, n, 10 ** 6) for n in (35, 36, 60, 200)]
    texts = [sentence(rnd, 150, 10 ** 6) for _ in range(60)]
    texts += [sentence(rnd, rnd.randrange(30), 10 ** 6) + " " + rnd.choice(shared) + " " + sentence(rnd, rnd.randrange(30), 10 ** 6) for _ in range(40)]
    texts += [texts[0], "ab " * 200, shared[2][:-1] + "x"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5000, sentence(random.Random(2), 90, 10 ** 6))] * 3
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), group_bytes=group_bytes, hash_bits=bits).collect()
    expected = [(r[0], *x) for r, x in zip(rows, _brute_repeats([r[1] for r in rows]))]
    assert sorted(map(str, expected)) == sorted(str((r.id, r.n_words, r.n_removed, r.kept_sha256)) for r in got)


# ---- 3 ----------------------------------------------------------------------
@pytest.mark.parametrize("bits", [256, 8])
def test_exact_duplicates(spark, bits):
    docs = edge_docs(spark)
    digest = exact_dedup.sha256 if bits == 256 else (lambda t: F.substring(exact_dedup.sha256(t), 1, 1))
    path = exact_dedup.staged(docs)
    got = exact_dedup.exact_duplicates(spark, path, batches=3, digest=digest).collect()
    groups = {}
    for r in edge_rows():
        groups.setdefault((r[1] or "").translate(LOWER), []).append(r[0])
    assert len(got) == len(edge_rows()) and sum(r.kept for r in got) == len(groups)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_hash[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_duplicates(spark, exact_dedup.staged(no_docs(spark))).count() == 0


def test_exact_duplicates_take_up_kept_state(spark, tmp_path):
    """Runs over a growing folder stream new files only, meet all earlier keys, and go on after a loss."""
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    deliveries = [edge_rows(), [(100 + (r[0] or 0), *r[1:]) for r in edge_rows()[:6]] + [(200, "new text", *[None] * 8)], [(300, "NEW text", *[None] * 8), (301, "alone", *[None] * 8)]]
    told, streamed = [], []
    for rows in deliveries:
        told += rows
        spark.createDataFrame(rows, edge_docs(spark).schema).repartition(3).write.mode("append").parquet(path)
        got = exact_dedup.exact_duplicates(spark, path, batches=2, state_dir=state).collect()
        batches = sorted((tmp_path / "state" / "changes").glob("batch=*"))
        streamed.append(len(batches))
        groups = Counter((r[1] or "").translate(LOWER) for r in told)
        assert Counter((r.text_sha256, r.group_size) for r in got) == Counter(
            {(hashlib.sha256(t.encode()).hexdigest(), n): n for t, n in groups.items()}) and sum(r.kept for r in got) == len(groups)
    assert streamed[0] < streamed[1] < streamed[2]
    latest = spark.read.parquet(str(tmp_path / "state" / "changes" / f"batch={streamed[2] - 1}"))
    assert latest.count() <= 2  # keys of the last delivery alone
    commits = tmp_path / "state" / "checkpoint" / "commits"
    for name in (f"{streamed[2] - 1}", f".{streamed[2] - 1}.crc"):  # lost before its last batch was marked as done
        if (commits / name).exists():
            (commits / name).unlink()
    again = exact_dedup.exact_duplicates(spark, path, batches=2, state_dir=state).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


# ---- 4, 5 -------------------------------------------------------------------
def _ids(name, end):
    t = Tokenizer.from_file(queries.tokenizer_file(name))
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_library(name, spaced):
    import pyarrow as pa

    texts = ["", " ", "a b", " a", "a ", "a  b", "\n\n a \n b\n", "İ ΑΣ é é ́x", "\x1c \x85 a\tb", "it's 12345 don't 100. a~ ~ b, C. d.. é. ×. 9.",
             "<|endoftext|> hi", "\U0001f600 \U0001f600.", "a\nb, c", "“q” – r", *[r[1] or "" for r in edge_rows()]]
    with open(queries.tokenizer_file(name), encoding="utf-8") as f:
        own = encode.Encoder(f.read(), spaced)
    expected = _ids(name, 0)
    for _ in range(2):  # unknown words, then known ones
        assert [x.tolist() for x in own.encode(pa.array(texts))] == [expected(t)[:-1].tolist() for t in texts]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_library_on_random_texts(name, spaced):
    import random
    import pyarrow as pa

    rnd = random.Random(14)
    space = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u200b\ufeff"
    some = "ab9.,'~-é×Ññß中ع\U0001f600\u0301#_<|>" + space + "    \n"
    texts = ["\xa0 e", "\n\xa0", "e\xa0 \n a"] + ["".join(rnd.choice(some) for _ in range(rnd.randrange(12))) for _ in range(40_000)]
    texts += ["".join(chr(rnd.choice((rnd.randrange(1, 0x250), rnd.randrange(1, 0xd7ff), rnd.randrange(0x10000, 0x10ffff)))) if rnd.random() < 0.5
                      else rnd.choice(some) for _ in range(rnd.randrange(9))) for _ in range(20_000)]
    with open(queries.tokenizer_file(name), encoding="utf-8") as f:
        own = encode.Encoder(f.read(), spaced)
    expected = [x.ids for x in Tokenizer.from_file(queries.tokenizer_file(name)).encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):  # words met earlier are known
        for text, x, y in zip(texts[at:at + 500], own.encode(pa.array(texts[at:at + 500])), expected[at:at + 500]):
            assert x.tolist() == y, repr(text)


def test_packing(spark):
    ids = _ids("byte_bpe_50k.json", 0)
    path = queries.tokenizer_file("byte_bpe_50k.json")
    rows = packing.pack(edge_docs(spark).repartition(5), path, open_bins=2).toPandas()
    expected = Counter()
    for r in edge_rows():
        own = ids(r[1])
        for i, (a, n) in enumerate(packing._pieces(len(own), 2048)):
            assert n <= 2048 and (i == 0 or n == 2048)
            expected[(str(r[0]), i, a, n, zlib.crc32(own[a:a + n].tobytes()))] += 1
    got = Counter((str(int(r.doc_id)) if r.doc_id == r.doc_id else "None", r.piece, r.start, r.length, r.ids_crc32) for r in rows.itertuples())
    assert got == expected
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == (s.length.cumsum() - s.length).tolist() and s.length.sum() <= 2048
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 2048) + 2
    assert packing.pack(no_docs(spark), path).count() == 0


def test_best_fit_is_bounded():
    packer = packing.BestFit(10, 2)
    assert [packer.put(n) for n in (6, 7, 8, 3, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0)]  # bin 1 is the fullest when 8 comes, bin 0 when 4 comes


def test_records(spark):
    ids = _ids("word_bpe_49k.json", 2)
    path, folder = queries.tokenizer_file("word_bpe_49k.json"), scratch_path(spark, "records")
    records.write_records(edge_docs(spark), folder, path, spaced=False, end_id=2, partitions=4)
    got = sorted(records.read_records(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in edge_rows()), key=lambda x: (x is not None, x or 0))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    expected = Counter((r[0], len(ids(r[1])), zlib.crc32(ids(r[1]).tobytes())) for r in edge_rows())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    drawn = records.read_shuffled(spark, folder, 7).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in drawn) == Counter((r[0], tuple(ids(r[1]).tolist())) for r in edge_rows())
    empty = scratch_path(spark, "records")
    assert records.write_records(no_docs(spark), empty, path, spaced=False, end_id=2).count() == 0 and records.read_records(spark, empty).count() == 0


def test_shards_are_listed_in_one_file(spark):
    """Tasks that encode write their shard and no table file of one row each."""
    folder = scratch_path(spark, "records")
    records.write_records(edge_docs(spark), folder, queries.tokenizer_file("word_bpe_49k.json"), spaced=False, end_id=2, partitions=4)
    tables = [p for p in Path(folder).rglob("part-*.parquet")]
    assert len(tables) == 1 and records.read_manifest(spark, folder).count() == len(list(Path(folder, "data").glob("part-*.rec"))) > 1


@pytest.mark.parametrize("name, end", [("word_bpe_49k.json", 2), ("byte_bpe_50k.json", 0)])
def test_encoding_takes_little_memory(name, end, monkeypatch):
    """A batch of 3 MB takes a share of the memory that numpy needs for it whole; kept words are bounded by their ids as well."""
    ids, texts = _ids(name, end), [" ".join(f"w{i * 200 + j}x" for j in range(200)) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    with open(queries.tokenizer_file(name), encoding="utf-8") as f:
        tokenizer = f.read()
    monkeypatch.setattr(encode, "encoder", lambda *a, own=encode.Encoder(tokenizer, "byte" in name): own)
    tracemalloc.start()
    for part, got in encode.encoded_slices([batch], "text", tokenizer, "byte" in name, end):
        assert part.num_rows == len(got)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    own = encode.encoder()
    monkeypatch.setattr(encode, "CACHE_IDS", 1000)
    assert len(own.flat) > 1000
    again = [x for _, got in encode.encoded_slices([batch.slice(0, 3)], "text", tokenizer, "byte" in name, end) for x in got]
    assert len(own.keys) == 600 and all((x == ids(t)).all() for x, t in zip(again, texts))


def _peak_mb(work):
    tracemalloc.start()
    for _ in work():
        pass
    peak = tracemalloc.get_traced_memory()[1] / (1 << 20)
    tracemalloc.stop()
    return peak


def test_encoder_keeps_the_words_met_again(monkeypatch):
    """A full store of words loses the rare ones, keeps the common ones and is bounded; ids stay what they are."""
    ids = _ids("byte_bpe_50k.json", 0)
    monkeypatch.setattr(encode, "CACHE_WORDS", 1000)
    with open(queries.tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        own = encode.Encoder(f.read(), True)
    learnt, learn = [], own._learn
    monkeypatch.setattr(own, "_learn", lambda *a: learnt.append(len(a[-1])) or learn(*a))
    for i in range(12):
        text = " ".join([f"common{j}x" for j in range(100)] + [f"rare{i}x{j}y" for j in range(400)])
        assert (own.encode(pa.array([text]))[0] == ids(text)[:-1]).all()
        assert len(own.keys) <= 1000 + 500 and len(own.again) == len(own.keys) == len(own.lens) == len(own.at)
    assert learnt == [500] + [400] * 11  # the common words once
    text = " ".join(f"common{j}x" for j in range(100)) + " " + " ".join(f"other{j}" for j in range(900))
    for _ in range(3):  # more words are common than half of the room: all go
        assert (own.encode(pa.array([text]))[0] == ids(text)[:-1]).all()
    assert len(own.keys) <= 2000


def test_slices_of_encoder_and_sketch_take_little_memory(monkeypatch):
    """A batch of 8 MB of words not met before: the memory of a slice and of the words kept."""
    texts = [" ".join(f"w{i * 400 + j}x" for j in range(400)) for i in range(2500)]
    batch = pa.RecordBatch.from_pydict({"node": range(2500), "text": texts, "said": range(2500)})
    with open(queries.tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    monkeypatch.setattr(encode, "encoder", lambda *a, own=encode.Encoder(tokenizer, True): own)
    sizes = _peak_mb(lambda: encode.encoded_slices([batch], "text", tokenizer, True, 0)), _peak_mb(lambda: near_dup._sketch(5, 128, 4)([batch]))
    assert sizes[0] < 48 and sizes[1] < 24


def test_batches_sent_to_packing_are_bounded_in_bytes(spark, monkeypatch):
    def sizes(*_):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((0, 0, 0, b.nbytes, 0, 0, 0, 0), (pa.int64(), pa.int32(), *[pa.int64()] * 6))]
                                                 + [pa.array([False])], names=[x.split()[0] for x in packing.PLACED.split(", ")])
        return run

    monkeypatch.setattr(packing, "_encode_and_pack", sizes)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10_000).alias("text"))
    got = [r.length for r in packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.json")).collect()]
    assert sum(got) >= 30_000_000 and max(got) < 6 << 20
    assert spark.conf.get(key, None) is None  # the session's setting is what it was
    spark.conf.set(key, "3m")
    try:
        packing.pack(docs, queries.tokenizer_file("byte_bpe_50k.json"))
        assert spark.conf.get(key) == "3m"
    finally:
        spark.conf.unset(key)


def test_damaged_record_is_noticed():
    whole = records.frame(b"payload")
    assert records.unframe(whole) == b"payload"
    for i in range(len(whole)):
        with pytest.raises(Exception):
            records.unframe(whole[:i] + bytes([whole[i] ^ 1]) + whole[i + 1:])


# ---- 6 ----------------------------------------------------------------------
def test_licenses(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", "plain words"), (3, "a/b/COPYING.txt", "head\nLicensed under CC BY-NC 4.0.\nmore"),
            (4, "a/b/c/d/y.txt", "this that"), (5, "a/z.txt", "Licensed under the Apache License, Version 2.0."), (6, "z.txt", None), (7, None, ""),
            (8, "ab/q.txt", "the license of a poet is not a notice"), (9, "a/w.txt", "long " * 5000), (9, "a/w.txt", "long " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, path string, text string").withColumns({c: F.lit("x") for c in ("id", "n", "own", "licence", "directory")})
    got = sorted({(r.id, r.own, r.licence, r.inherited_from) for r in licenses.scan(docs).collect()})
    assert got == [(1, "MIT", "MIT", "a"), (2, None, "CC-BY-NC-4.0", "a/b"), (3, "CC-BY-NC-4.0", "CC-BY-NC-4.0", "a/b"), (4, None, "CC-BY-NC-4.0", "a/b"),
                   (5, "Apache-2.0", "Apache-2.0", "a"), (6, None, None, None), (7, None, None, None), (8, None, None, None), (9, None, "MIT", "a")]
    assert licenses.scan(docs).count() == len(rows) and licenses.scan(docs.limit(0)).count() == 0


def test_licenses_of_shuffled_input(spark):
    """Row numbers hold whatever plan the rows come from."""
    rows = [(i, f"d{i}/x.txt", ("Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "plain words")[i % 3]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        for given in (docs.repartition("doc_id"), docs.repartition(40).join(spark.range(1500).withColumnRenamed("id", "doc_id"), "doc_id")):
            assert {r.id: r.own for r in licenses.scan(given).collect()} == {i: ("Apache-2.0", "MIT", None)[i % 3] for i, *_ in rows}
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)


def _brute_licences(rows, least=0.7):
    from collections import Counter
    from math import log, sqrt
    split = licenses._words
    df = Counter(t for _, x in rows for t in set(split(x)))
    idf = lambda t: 1 + log((1 + len(rows)) / (1 + df[t]))
    vector = lambda x: {t: n * idf(t) for t, n in Counter(x).items()}
    out = {}
    for i, text in rows:
        best = {}
        for k, (lic, notice) in enumerate(licenses.TEMPLATES):
            b, x = vector(split(notice)), split(text)
            size = len(split(notice))
            units = [split(y) for y in re.split("\r\n|\r|\n", text)] + [x[j:j + size] for j in range(max(0, len(x) - size) + 1)]
            for u in units:
                a = vector(u)
                if a:
                    score = round(sum(v * b.get(t, 0) for t, v in a.items()) / sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())), 6)
                    if score >= least:
                        f = best.setdefault(lic.split("-")[0], [(0,), (0,)])
                        f[0] = max(f[0], (score, -k, lic))
                        if notice not in licenses.SHARED:
                            f[1] = max(f[1], (score, -k, lic))
        top = max(((*a[:2], (b if len(b) > 1 else a)[2]) for a, b in best.values()), default=(None, None, None))
        out[i] = (top[2], top[0])
    return out


def test_license_windows(spark):
    import random
    rnd = random.Random(6)
    gpl = "This program is free software: you can redistribute it and/or modify it\nunder the terms of the GNU {}General Public License as published by\nthe Free Software Foundation; either version {} of the License, or (at your option) any later version."
    notices = [("MIT", "All code here is released under the MIT License."), ("MIT", "Copyright 2024 Jane Doe. Released under the MIT License."),
               ("MIT", "Released under the MIT License, see the LICENSE file for details."), ("Apache-2.0", "Copyright 2020 Google Inc. Licensed under the\n# Apache License,\n# Version 2.0 (the License);"),
               ("GPL-2.0", gpl.format("", "2")), ("GPL-3.0", gpl.format("", "3")), ("AGPL-3.0", gpl.format("Affero ", "3")), ("LGPL-2.1", gpl.format("Lesser ", "2.1")),
               ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n Copyright (C) 1989, 1991"), ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007"),
               ("BSD-2-Clause", licenses.BSD[0] + licenses.BSD[2]), ("BSD-3-Clause", "\n".join(licenses.BSD)), ("MIT", licenses.MIT.replace("person", "one"))]
    rows = [(i, sentence(rnd, 30) + "\n" + x + " " + sentence(rnd, 20)) for i, (_, x) in enumerate(notices)]
    rows += [(100 + i, sentence(rnd, 60) + "\nthe use of this version without the software and a license") for i in range(30)] + [(200, "MIT License"), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("path", F.lit("x.txt"))
    got = {r.id: (r.own, r.score) for r in licenses.scan(docs).collect()}
    assert {i: got[i][0] for i in range(len(notices))} == {i: x for i, (x, _) in enumerate(notices)} and got[100][0] is None
    brute = _brute_licences(rows)
    assert {i: x for i, (x, _) in got.items()} == {i: x for i, (x, _) in brute.items()}
    assert all(abs((s or 0) - (brute[i][1] or 0)) < 2e-6 for i, (_, s) in got.items())


# ---- 7 ----------------------------------------------------------------------
def _features(text, learned):
    """The twelve features counted in plain Python."""
    lower = text.lower()
    words = regex.findall(r"\p{L}+", lower)
    n, chars = max(len(words), 1), max(len(text), 1)
    hit = lambda w, lexicon: w in lexicon or any(w[:k] + "*" in lexicon and len(w) >= k for k in (4, 5, 6))
    both = {*learned, *toxicity.INSULTS}
    own, fixed = sum(hit(w, learned) for w in words), sum(w in toxicity.INSULTS for w in words)
    near = sum(hit(w, both) and any(x in toxicity.SECOND_PERSON for x in words[max(0, i - 5):i + 6]) for i, w in enumerate(words))
    undone = regex.findall(r"\p{L}+", lower.translate(str.maketrans(toxicity.SWAPPED, toxicity.MEANT)))
    swapped = sum(hit(w, both) for w in undone) if regex.search(r"\p{L}[0134578@$]|[0134578@$]\p{L}", text) else 0
    count = lambda pattern: len(regex.findall(pattern, text))
    capital_words = len([w for w in regex.findall(r"[\p{L}\p{N}_]+", text) if len(w) > 2 and regex.fullmatch(r"\p{Lu}+", w)])
    return [own / n, min(own, 20), fixed / n, min(fixed, 20), near / n, count(r"\p{Lu}") / chars, capital_words / n, count("[!?]") / chars,
            count(r"[^\p{L}\p{N}\s]") / chars, len([m for m in regex.finditer(r"(\p{L})\1{2,}", text)]) / n, count(r"\p{L}[0-9@$*!#%]+\p{L}") / n, max(0, swapped - own)]


def test_toxicity_features(spark):
    learned = ["vile", "grum*", "snivel*", "scumbag", "é"]
    texts = ["", None, " \n", "You are a VILE grumbler!!! idiot, you", "vile " * 30 + "x y z you", "1d10t m0r0n v1le gr00m", "sooo baaad!? S$$T f**k a1b2c", "Sniveling SNIVELER dû à tü DICH Dummkopf",
             "no insults here, only 3 numbers: 12 and 4.", "a " * 6 + "trash " + "b " * 5 + "you " + "c " * 9 + "scumbag", "AAA BBB ccc DDD1 E_F", "é" * 3 + " É", "word " * 5000 + "loser you"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    df, names = toxicity.features(docs, "text", learned)
    assert len(names) == 12
    for r in df.collect():
        for name, a, b in zip(names, (r[c] for c in names), _features(texts[r.doc_id] or "", learned)):
            assert a == pytest.approx(b, abs=1e-12), (texts[r.doc_id], name)


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    seen = model.score(docs).join(labels, "doc_id").toPandas()
    assert ((seen.predicted == 1) & (seen.toxic == 0)).mean() < 0.02 and seen[seen.toxic == 1].score.mean() > 0.5
    unseen = model.score(docs.filter(toxicity.held_out())).join(labels, "doc_id").filter("toxic IS NOT NULL").toPandas()
    assert len(unseen) > 20 and (unseen.predicted == unseen.toxic).mean() > 0.9 and ((unseen.predicted == 1) & (unseen.toxic == 0)).mean() < 0.02
    edge = model.score(edge_docs(spark)).toPandas()
    assert len(edge) == len(edge_rows()) and edge.score.between(0, 1).all() and list(edge.columns[:3]) == ["doc_id", "text", "lang"]
    assert model.score(no_docs(spark)).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert none.score(edge_docs(spark)).agg(F.max("score")).first()[0] == 0.0
    one = toxicity.fit(docs, labels.filter("toxic = 1").withColumn("toxic", F.when(F.col("doc_id") % 2 == 0, F.col("toxic"))))
    assert one.score(edge_docs(spark)).agg(F.min("score")).first()[0] == 1.0


# ---- 8 ----------------------------------------------------------------------
def _brute_components(rows):
    sets = {}
    for doc, text in rows:
        w = WORDS((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


@pytest.mark.parametrize("blocks", [1, 3])
def test_near_duplicates(spark, blocks, monkeypatch):
    import random
    rnd = random.Random(9)
    shared = sentence(rnd, 60)
    rows = [(i, t) for i, t, *_ in edge_rows() if i is not None and i != 11]
    rows = list({i: (i, t) for i, t in rows}.values())
    for i in range(60):  # texts around the threshold that share a passage, chained by their own words
        rows.append((100 + i, shared + " " + " ".join(f"own{(i + j) // 2}" for j in range(18))))
    if blocks > 1:
        monkeypatch.setattr(near_dup, "BLOCK", 20)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("node", "n_shingles", "label", "bands", "key")})
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert got == _brute_components(rows)


def test_near_duplicates_edges(spark):
    got = near_dup.near_duplicates(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert {r.component_id for r in got if r.id in (1, 2, 3, 4)} == {1}
    assert near_dup.near_duplicates(no_docs(spark)).count() == 0


def test_near_duplicates_of_few_words(spark):
    """3 of 4 shingles, two shared buckets, but 55 of 128 bins; and small sets without any common bin."""
    import numpy as np
    import pandas as pd
    text = "w349724 w69932 w557383 w221045 w473402 w982413 w80122 w743495"
    docs = spark.createDataFrame([(1, text), (2, text.rsplit(" ", 1)[0]), (3, "other words")], "doc_id bigint, text string")
    assert {r.id: r.component_id for r in near_dup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3}
    sets = [[1, 2, 3, 4], [1, 2, 4], [1, 2], [4, 5, 6]]
    block = pd.DataFrame({"side": 1, "node": range(4), "label": range(4), "sig": [bytes([i] * 128) for i in range(4)],
                          "shingles": [np.array(x, np.uint64).tobytes() for x in sets]})
    assert near_dup._cross(near_dup.CROSS_AGREE, 75)(block).values.tolist() == [[0, 1]]


def test_near_duplicates_of_repeated_ids(spark):
    """The texts of one id are each other's links, whichever of them its row is found by."""
    import random
    rnd = random.Random(12)
    rows = []
    for i in range(4):
        texts = [sentence(rnd, 60, 10 ** 6) for _ in range(4)]
        rows += [(10 * i, t) for t in texts] + [(10 * i + 1 + k, t + " end") for k, t in enumerate(texts)] + [(10 * i + 8, sentence(rnd, 60, 10 ** 6))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows) and {(r.id, r.component_id) for r in got} == {(i, i if i % 10 == 8 else i // 10 * 10) for i, _ in rows}


# ---- 9 ----------------------------------------------------------------------
def test_url_rules(spark):
    rules = [*queries.URL_RULES, ("block", "com", "/x"), ("allow", "", "")]
    urls = ["http://a.com", "http://a.com/", "HTTPS://WWW.Example.COM/en/1?q#f", "http://m.example.com/en/2", "http://a.net/es/", "http://a.net/es", "http://xnet/es/1",
            "http://net/fr/1/", "http://com/xyz", "http://a.com//x", "nothing", "", None, None, "http://", "x://a..com/a/b/c", "http://a.com:80/", "http://a.net?u=/es/", "http://" + "a." * 500 + "com/" + "b/" * 500]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "digest", "best")})
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rule_table(spark, rules[:6])).collect()}
    for i, url in enumerate(urls):
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
        fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules[:6] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        assert got[i] == (host, path, best[3], best[4]), url
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, rules[:6])).count() == 0
    assert url_rules.judge(pages, url_rules.rule_table(spark, rules).limit(0)).filter("rule IS NOT NULL").count() == 0


# ---- 10 ---------------------------------------------------------------------
def _said(parts):
    """Role and text per turn and the learned texts, put together over a conversation's windows."""
    said, learned = [], []
    for r in parts:
        for t in r.turns:
            assert t.continued == bool(said and said[-1][2]) and (not t.continued or said[-1][0] == t.role)
            said = said[:-1] + [(t.role, said[-1][1] + t.text, t.continues)] if t.continued else said + [(t.role, t.text, t.continues)]
        learned.extend(r.learned)
    return [x[:2] for x in said], learned


def _chat_rows():
    rows = [(1, 0, "system", "be \\ brief <|"), (1, 1, "user", "a" * 300), (1, 2, "assistant", "b" * 900 + "\n"), (1, 3, "user", None), (1, 4, "assistant", "c<"),
            (2, 0, "assistant", queries.CONTROL), (3, 0, "system", "alone"), (None, None, None, None), (None, 0, "role\nx", "<\\|"), (1, 4, "assistant", "c<")]
    rows += [(4, t, ("user", "assistant")[t % 2], f"{t} " * (t % 7 * 40)) for t in range(1, 700)] + [(5, 1, "assistant", "long " * 4000)]
    rows += [(6, 0, "system", "rule " * 60), (6, 0, "system", "rule " * 60), (6, 1, "user", "\\<|é \n\n\U0001f600 12345" * 300), (6, 2, "assistant", "\\" * 999 + "<|im_more|><|im_cont|>" * 90)]
    rows += [(7, 0, "system", "too long a rule " * 200), (7, 1, "assistant", "x"), (8, 1, "system\\" * 3000, "role"), (8, 2, "r " * 90, "text " * 900), (9, 0, "system", "w " * 5000)]
    return rows + [(10, -t if t else None, "tool", f"{t}!") for t in range(40)]


@pytest.mark.parametrize("budget,history,salt_turns", [(400, 2, 10_000), (64, 0, 100), (4096, 3, 10_000)])
def test_chat_windows(spark, budget, history, salt_turns, monkeypatch):
    monkeypatch.setattr(chat, "SALT_TURNS", salt_turns)
    rows = _chat_rows()
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit("x") for c in ("window", "pos", "conv", "cost", "head", "cell", "parts", "f")})
    windows = chat.saved(chat.format_windows(turns, budget=budget, history_turns=history), "windows")
    read = chat.read_turns(windows).collect()
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said, learned = _said(sorted((r for r in read if r.conv_id == conv), key=lambda r: r.window))
        assert said == [(r[2] or "", r[3] or "") for r in mine]
        assert "".join(learned) == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    count = re.compile(chat.TOKEN, re.S).findall
    for r in windows.collect():
        texts = re.split(r"<\|im_(?:start|end|more|cont)\|>", r.formatted)
        spent = sum(len(count(t)) for t in texts) + len(texts) - 1  # an upper bound, with control strings of one token
        assert r.conv_id == 8 or (spent <= r.n_tokens + 2 * r.formatted.count(chat.START) and r.n_tokens <= budget), (r.conv_id, spent, r.n_tokens)
        if r.conv_id in (1, 6) and budget == 400 or r.conv_id == 7 and budget == 4096:
            assert r.formatted.startswith(chat.START + "system\n")
    by_conv = {c: [r for r in read if r.conv_id == c] for c in (4, 5)}
    assert len(by_conv[4]) > 5 and windows.filter("conv_id = 4 AND n_repeated > 0").isEmpty() == (history == 0)
    assert len(by_conv[5]) >= 4000 / budget and all(len(r.turns) == 1 for r in by_conv[5])
    assert chat.format_windows(turns.limit(0)).count() == 0
