"""One-permutation MinHash with optimal densification (numpy, per slice of documents)."""

from __future__ import annotations

import numpy as np

from staylake.llm.words import BASE2, U, Words, mix, window_hashes

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every distinct ``k``-word shingle, sorted by both.
    A document with fewer words has its whole sequence as one; without words, none."""
    at, h = words.windows(k)
    doc = np.searchsorted(words.first, at, side="right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        own = window_hashes(words.hashes, words.first[short], words.first[short + 1], BASE2)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, own])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """``n_docs x bins`` signatures. ``bins`` must be a power of two.

    The top bits of a hash name its bin and each bin keeps its smallest hash.
    An empty bin takes the value of the first filled bin on its own random walk
    over the bins, which is the same walk for every document (optimal
    densification). Documents without shingles keep EMPTY everywhere.
    """
    shift = U(64 - bins.bit_length() + 1)
    sig = np.full((n_docs, bins), EMPTY, np.uint64)
    if not len(h):
        return sig
    b = (h >> shift).astype(np.int64)
    head = np.ones(len(h), bool)  # sorted by (document, hash), so the first of each bin is its smallest
    head[1:] = (doc[1:] != doc[:-1]) | (b[1:] != b[:-1])
    sig[doc[head], b[head]] = h[head]
    filled = sig != EMPTY
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    step = 0
    while len(row):
        step += 1
        to = (mix(col.astype(np.uint64) * U(0x632BE59BD9B4E019) + U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> shift).astype(np.int64)
        ok = filled[row, to]
        sig[row[ok], col[ok]] = sig[row[ok], to[ok]]
        row, col = row[~ok], col[~ok]
    return sig


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` consecutive signature values; the band number is mixed in."""
    n, bins = sig.shape
    bands = sig.reshape(n, bins // rows, rows)
    key = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), (n, bins // rows)).copy()
    for r in range(rows):
        key = mix(key * U(0xD1342543DE82EF95) + bands[:, :, r])
    return key
