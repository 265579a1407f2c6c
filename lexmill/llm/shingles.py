"""Hashed word shingles: A-Z lower-cased, words between ASCII white space, five words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .words import blocks, spelled

WORDS = 5
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of `size` words, given those of the words; mixed at each word: no two orders agree by algebra."""
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = mixed(out + h[k : len(h) - size + 1 + k] * _ODD[k])
    return out


def shingled(texts: pa.Array):
    """The sets of shingles of texts (null: empty), as sorted 64-bit hashes. Sets with equal hashes count as equal."""
    for a, b in blocks(texts):
        offsets, index, words = spelled(texts.slice(a, b - a), lower=True)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))[index]
        windows = hashed(h, WORDS) if len(h) >= WORDS else h[:0]
        for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if y - x >= WORDS:
                yield np.unique(windows[x : y - WORDS + 1])
            else:
                yield hashed(h[x:y], y - x) if y > x else h[:0]


def shingle(text: str | None) -> np.ndarray:
    return next(shingled(pa.array([text], pa.string())))
