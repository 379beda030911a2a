"""Token ids of whole texts, by the tokenizers library, once per distinct word.

Both supported vocabularies split a text at white space before they merge
bytes, so the words of a slice are found by hash (``words.py``), every word not
met before is encoded once, many joined in one call, and the ids are put
together with numpy. What is kept of earlier words belongs to the Python
worker; before a slice, if it holds over ``CACHE_WORDS`` words or ``CACHE_IDS``
of their ids, the words not met again since are dropped (most words of real
texts are rare; the common ones stay known). Slices are small, as numpy takes
about 100 bytes for each of theirs, and a task encodes on its own core alone. The
result equals encoding the text in one call; texts where cutting at white space
could differ (gaps other than one space or line break for a vocabulary that
keeps spaces, white space beyond ASCII) take that call; their words are not looked up.

Words are told apart by 64-bit hashes: among the words of a full cache two
collide with a chance of about 1e-8.
"""

from __future__ import annotations

import os
import sys
from types import ModuleType
from typing import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from staylake.llm import words

CACHE_WORDS, CACHE_IDS = 400_000, 2_000_000
ENCODE_BYTES = 1 << 18
JOINED = 400


class Encoder:
    """``spaced``: the vocabulary keeps a word's leading space (byte-level BPE); otherwise spaces vanish."""

    def __init__(self, tokenizer_json: str, spaced: bool):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.spaced = spaced
        # a token that no word can contain or touch stands between joined words
        self.mark, self.between = ("\n", "\n") if spaced else ("~", " ~ ")
        self.mark_id = self.tokenizer.encode(self.mark, add_special_tokens=False).ids[0]
        self.stop_ids = np.zeros(128, np.uint32)
        for c in (".", ","):
            self.stop_ids[ord(c)] = self.tokenizer.encode(c, add_special_tokens=False).ids[0]
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.lens = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)  # met in a later slice as well
        self.flat = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Drop the words not met again; all words, if those met again take over half of the room."""
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > CACHE_WORDS or 2 * int(self.lens[kept].sum()) > CACHE_IDS:
            kept = kept[:0]
        lens = self.lens[kept].astype(np.int64)
        at = np.cumsum(lens) - lens
        inside = np.arange(int(lens.sum())) - np.repeat(at, lens)
        self.flat = self.flat[np.repeat(self.at[kept], lens) + inside]
        self.keys, self.at, self.lens, self.again = self.keys[kept], at, self.lens[kept], np.zeros(len(kept), bool)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, spaces: np.ndarray, keys: np.ndarray) -> bool:
        """Encode new and distinct words, each followed by the mark, many in one text. False, and
        nothing learnt, if a word does not stay apart from its mark."""
        size = ends - starts
        step = spaces + size + len(self.between)
        to = np.cumsum(step) - step
        joined = np.full(int(step.sum()), 32, np.uint8)
        joined[to + spaces + size + len(self.between) // 2] = ord(self.mark)
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(to + spaces, size) + inside] = data[np.repeat(starts, size) + inside]
        raw, cut = joined.tobytes(), [*to[::JOINED], len(joined)]
        ids = np.concatenate(self._ids([raw[a:z].decode() for a, z in zip(cut, cut[1:])]))
        marks = np.flatnonzero(ids == self.mark_id)
        if len(marks) != len(keys):
            return False
        lens = np.diff(marks, prepend=-1) - 1
        at = len(self.flat) + np.cumsum(lens) - lens
        self.flat = np.concatenate([self.flat, np.delete(ids, marks)])
        to = np.searchsorted(self.keys, keys)  # both are sorted
        self.keys, self.at, self.lens = np.insert(self.keys, to, keys), np.insert(self.at, to, at), np.insert(self.lens, to, lens)
        self.again = np.insert(self.again, to, False)
        return True

    def _kinds(self, data: np.ndarray, offsets: np.ndarray, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """What stands before each word (0 nothing, 1 a space, 2 a line break) and the documents to encode whole."""
        n_docs = len(offsets) - 1
        odd = np.isin(data, (0xE1, 0xE2, 0xE3)) | ((data >= 0x1C) & (data <= 0x1F))
        odd[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        total = np.concatenate([[0], np.cumsum(odd)])
        whole = total[offsets[1:]] > total[offsets[:-1]]
        kinds = np.zeros(len(w.starts), np.int64)
        if not self.spaced:
            return kinds, whole
        doc = np.repeat(np.arange(n_docs), w.counts)
        lead = np.ones(len(w.starts), bool)
        lead[w.first[:-1][w.counts > 0]] = False  # words that follow another one of their document
        before = np.zeros(len(w.starts), np.int64)
        before[1:] = w.ends[:-1]
        before = np.where(lead, before, offsets[doc])
        gap = w.starts - before
        byte = data[np.maximum(w.starts - 1, 0)] if len(data) else np.zeros(0, np.uint8)
        kinds = np.where(gap == 0, 0, np.where(byte == 32, 1, 2))
        bad = (gap > 1) | ((gap == 1) & (byte != 32) & (byte != 10))
        np.logical_or.at(whole, doc[bad], True)
        last = np.where(w.counts > 0, w.ends[np.maximum(w.first[1:] - 1, 0)] if len(w.ends) else 0, offsets[:-1])
        return kinds, whole | (last != offsets[1:])

    def _stops(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which words end in a full stop or comma that is a token of its own: one that follows a
        letter or digit of ASCII, or a Latin letter of two bytes."""
        last, before, lead = (data[np.maximum(ends - i, 0)] for i in (1, 2, 3))
        plain = ((before >= 48) & (before <= 57)) | (((before | 32) >= 97) & ((before | 32) <= 122))
        latin = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (ends - starts > 2)
        return ((last == 46) | (last == 44)) & (ends - starts > 1) & (plain | latin)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        data, offsets = words.buffers(texts)
        w = words.parse(data, offsets, hashed=False)
        kinds, whole = self._kinds(data, offsets, w)
        if not self.spaced:
            data = words.lowered(data)  # as the vocabulary does
            total = np.concatenate([[0], np.cumsum(data == ord(self.mark))])
            marked = total[w.ends] > total[w.starts]
            whole[np.repeat(np.arange(len(texts)), w.counts)[marked]] = True
        if len(self.keys) > CACHE_WORDS or len(self.flat) > CACHE_IDS:
            self._forget()
        live = ~np.repeat(whole, w.counts)  # words of texts encoded in one call are not looked up
        starts, ends, kinds = w.starts[live], w.ends[live], kinds[live]
        first = np.concatenate([[0], np.cumsum(np.where(whole, 0, w.counts))])
        if not len(starts):
            ids = [np.zeros(0, np.uint32) for _ in range(len(texts))]
        else:
            stop = self._stops(data, starts, ends)
            ends = ends - stop
            spaces = (kinds == 1).astype(np.int64)
            keys = words.mix(words.word_hashes(data, starts, ends) + spaces.astype(np.uint64) * words.U(0x632BE59BD9B4E019))
            distinct, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
            place = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
            new = self.keys[place] != distinct if len(self.keys) else np.ones(len(distinct), bool)
            self.again[place[~new]] = True
            if new.any():
                some = example[new]
                if not self._learn(data, starts[some], ends[some], spaces[some], distinct[new]):
                    return self._ids(texts.to_pylist())
                place = np.searchsorted(self.keys, distinct)
            code = place[inverse]
            own, breaks = self.lens[code].astype(np.int64), (kinds == 2).astype(np.int64)
            lens = own + breaks + stop
            total = np.cumsum(lens)
            out = np.full(int(total[-1]), self.mark_id, np.uint32)  # line breaks keep this id
            out[total[stop] - 1] = self.stop_ids[data[ends[stop]]]
            inside = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            out[np.repeat(total - stop - own, own) + inside] = self.flat[np.repeat(self.at[code], own) + inside]
            cut = np.concatenate([[0], total])[first]
            ids = [out[a:z] for a, z in zip(cut[:-1], cut[1:])]
        apart = np.flatnonzero(whole)
        for i, x in zip(apart, self._ids([texts[int(i)].as_py() for i in apart]) if len(apart) else ()):
            ids[i] = x
        return ids


def encoder(tokenizer_json: str, spaced: bool) -> Encoder:
    """The worker's encoder of this vocabulary; it outlives a task, the words it has met with it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # else it starts a thread per core of the machine
    kept = sys.modules.setdefault("_staylake_encoders", ModuleType("_staylake_encoders")).__dict__
    name = f"{hash(tokenizer_json)}-{spaced}"
    if name not in kept:
        kept[name] = Encoder(tokenizer_json, spaced)
    return kept[name]


def encoded_slices(batches, text: str, tokenizer_json: str, spaced: bool, end_id: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of rows with the ids of each text, the end id added."""
    own, end = encoder(tokenizer_json, spaced), np.array([end_id], np.uint32)
    for batch in batches:
        for part in words.slices(batch, text, ENCODE_BYTES):
            yield part, [np.concatenate([ids, end]) for ids in own.encode(part.column(part.schema.get_field_index(text)))]
