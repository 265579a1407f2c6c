"""Words between ASCII white space, for a whole Arrow batch at once.

A block of texts becomes its distinct words and, for every word in it, the place among these. What is costly per word
(hashing, encoding) is then done once a block, in memory that the block bounds; nothing is kept between blocks.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a block, about; a longer text is a block of its own.
BLOCK = 6_000_000


def release() -> None:
    """Give memory that is no longer in use back to the system: workers outlive their tasks, and others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable) -> Callable:
    """run, a function for mapInArrow, with `release` after its last batch."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return inner


def joined(batches: Iterator[pa.RecordBatch], size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about `size` bytes, so that work per block doesn't depend on how Spark cuts batches."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if total:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + size, "right")))
        yield start, end
        start = end


def spelled(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, index, words): text i has the words index[offsets[i]:offsets[i + 1]] of the distinct words; null: none.

    lower: A-Z are made a-z.
    """
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    found = parts.flatten().dictionary_encode()
    index, words = found.indices.to_numpy(), found.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # white space at an end of a text makes an empty part
        real = index != empty
        offsets = np.r_[0, np.cumsum(real)][offsets]
        index = index[real]
    return offsets, index, words


def gathered(index: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The concatenation of the groups index[0], index[1], … of flat, whose groups have the given sizes."""
    if not len(index):
        return flat[:0]
    ends = np.cumsum(sizes)
    n = sizes[index]
    upto = np.cumsum(n)
    kind = np.int32 if max(int(upto[-1]), len(flat)) < 1 << 31 else np.int64  # at half the memory where it fits
    at = np.repeat(((ends - sizes)[index] - (upto - n)).astype(kind), n)
    at += np.arange(len(at), dtype=kind)
    return flat[at]
