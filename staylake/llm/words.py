"""Vectorised word hashing of whole Arrow text columns.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``. A batch of
texts is handled as one byte array: word and window hashes come from prefix
sums of a polynomial modulo 2**64 (random byte weights, then a 64-bit mixing
step), so no Python code runs per word. Texts are taken in slices of about a
megabyte, whole documents at a time, which bounds the memory of a task by the
slice or by the longest single document.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE, BASE2 = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1
MASK = (1 << 64) - 1
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64, element by element."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_weights() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * U(BASE))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[s:e]`` for every (s, e): equal sequences hash alike wherever they start."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    back = powers(pow(base, -1, 1 << 64), n + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * U(0xA0761D6478BD642F))


@dataclass
class Words:
    """Words of a slice of documents: byte ranges, hashes, and each document's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # len(docs) + 1: word range of every document

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``k`` words inside one document."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)  # words from here to the document's end
        at = np.flatnonzero(left >= k)
        return at, window_hashes(self.hashes, at, at + k, BASE2)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return window_hashes(byte_weights()[data], starts, ends, BASE)


def parse(data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True) -> Words:
    """Words of the documents ``data[offsets[i]:offsets[i + 1]]``; ``hashed=False`` leaves their hashes out."""
    if lower:
        data = lowered(data)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    n = len(data)
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = gap[:-1], gap[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    hashes = word_hashes(data, starts, ends) if hashed else np.zeros(0, np.uint64)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a text column without NULLs."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows with about ``size`` bytes of text each."""
    if not batch.num_rows:
        return
    _, off = buffers(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(off, off[start] + size, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def parsed_slices(batches, text: str, lower: bool = False, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for part in slices(batch, text, size):
            yield part, parse(*buffers(part.column(part.schema.get_field_index(text))), lower)


def joined(words: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the documents' (kept) words joined by one space each."""
    lens, doc = words.ends - words.starts, np.repeat(np.arange(len(words.counts)), words.counts)
    starts = words.starts
    if keep is not None:
        lens, doc, starts = lens[keep], doc[keep], starts[keep]
    head = np.ones(len(doc), bool)
    head[1:] = doc[1:] != doc[:-1]
    to = np.cumsum(lens + ~head) - lens  # where each word goes; a space stands before all but a document's first
    total = int(to[-1] + lens[-1]) if len(lens) else 0
    out = np.full(total, 32, np.uint8)
    word = np.repeat(np.arange(len(lens)), lens)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lens) - lens, lens)
    out[to[word] + inside] = words.data[starts[word] + inside]
    end = np.zeros(len(words.counts) + 1, np.int64)
    np.maximum.at(end, doc + 1, to + lens)
    return out, np.maximum.accumulate(end)
