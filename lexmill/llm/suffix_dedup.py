"""Removal of repeated passages by prefix-free parsing and suffix arrays.

A byte is removed if a string of `length` bytes that covers it also starts anywhere else in the corpus.

1. Parse. A rolling hash of 8 bytes cuts each text into phrases at its triggers. Triggers depend on these bytes alone,
   so equal strings are cut alike, and a string's first trigger (within its first length - KEY bytes) is its anchor.
   An anchor's entry is its context: all strings anchored there. Its key is the KEY bytes from the trigger. A string
   with no trigger there is an entry of its own. Anchors meet by key: a key met once drops out with all its strings, and
   an entry that occurs twice or more is repeated whole (its copies are one entry of the dictionary).
2. Order. The remaining entries of a range of keys are ordered together. What follows each trigger is ordered by the
   suffix array of the parse (ranks of phrases, sorted by prefix doubling), what precedes it by the sorted suffixes of
   the dictionary. Both together are the corpus order of the anchored strings, cut at `length` bytes; equal strings share
   their anchor's key, so no order across ranges of keys is needed. Strings that lie together in both orders repeat.
3. The repeated strings of each document are united and cut out.

Entries that occur several times in a map task are sent once, so copies don't gather. Where a key has more than MANY
entries, its strings are counted one by one with partial sums, and no task holds them together. Only documents with a mark have their text shuffled (if their list passes a size check it is broadcast).
Digests are 64 bits, compared only under equal 64-bit keys, or 128 bits.

Defined cases: null text is empty; texts shorter than `length` keep all; matches never cross documents; repeated rows
remove each other; null doc_ids are kept; an empty table gives no rows; further columns are ignored by `repeats` and kept
by `without_repeats` (whose cut texts drop bytes of characters that were cut in two).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, width
from .ngram_join import PARTITIONS, _arrays, _groups
from .shingles import mixed
from .words import trimmed

LENGTH = 200
#: Bytes from a trigger that make an anchor's key; bytes per phrase, on average.
KEY, PHRASE = 32, 32
#: Anchors that a map task holds before it sends them.
BLOCK = 400_000
#: Documents per fragment of the keys, about, and the most fragments.
DOCS_PER_FRAGMENT, FRAGMENTS = 3000, 1 << 20
#: A key with more entries than this (some 250 bytes each) is split by its strings.
MANY = 2000
#: Bytes of a text in which triggers are sought at a time, and of entries that are ordered together.
WINDOW, ORDER = 1 << 18, 1_500_000
#: Up to so many marked documents (16 bytes each), their list is broadcast.
BROADCAST_DOCS = 1_000_000
_NULL = -(1 << 63)
_U64, _I64, _I32, _U8 = np.dtype("<u8"), np.dtype("<i8"), np.dtype("<i4"), np.dtype("u1")


def triggers(data: bytes) -> np.ndarray:
    """Places where a phrase begins: the hash of 8 bytes is low."""
    if len(data) < 8:
        return np.zeros(0, np.int64)
    x = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        h = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return np.flatnonzero(h < np.uint64((1 << 64) // PHRASE))


def anchors(data: bytes, length: int = LENGTH, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, digest, trigger, first, last) of the anchors, a window at a time: the strings that start at first..last are
    anchored there. A string without an anchor is one of its own."""
    top = len(data) - length  # the last start
    if top < 0:
        return
    reach = length - KEY
    digest = xxhash.xxh3_64_intdigest
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def loose(a: int, b: int):
        for x in range(a, b + 1, window):
            at = np.arange(x, min(x + window, b + 1))
            d = np.fromiter((digest(data[s : s + length], 1 << 20) for s in at.tolist()), np.uint64, len(at))
            yield d, d, at, at, at

    before = -1
    for a in range(0, top + reach + 1, window):
        end = min(a + window, top + reach + 1)
        t = triggers(data[a : end + 7]) + a
        last = np.r_[before, t[:-1]] if len(t) else t
        lo, hi = np.maximum(np.maximum(last + 1, t - reach), 0), np.minimum(t, top)
        ok = lo <= hi
        at, lo, hi = t[ok], lo[ok], hi[ok]
        if len(at):
            key = np.full(len(at), 1, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(0, KEY, 8):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
            yield key, np.fromiter((digest(data[x : y + length], z - x) for x, y, z in zip(lo.tolist(), hi.tolist(), at.tolist(), strict=True)), np.uint64, len(at)), at, lo, hi
        for k in np.flatnonzero(t - last > reach + 1).tolist():
            yield from loose(int(last[k]) + 1, min(int(t[k]) - reach - 1, top))
        before = int(t[-1]) if len(t) else before
    yield from loose(before + 1, top)


def _united(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals [s, e), touching ones joined."""
    if not len(s):
        return s, e
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.r_[True, s[1:] > e[:-1]]
    return s[new], e[np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]]


_PARSED = "frag int, kind int, doc binary, hash binary, n binary, key binary, digest binary, at binary, lo binary, hi binary, more binary"
_MARKS = "bucket int, doc binary, hash binary, n binary, lo binary, hi binary, at binary, key binary, flag binary"


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    of = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, of[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _by_owner(owner: np.ndarray, doc: np.ndarray, h: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """doc, hash and counts of the owners of rows that are sorted by owner."""
    who, n = np.unique(owner, return_counts=True)
    return doc[who].tobytes(), h[who].tobytes(), n.astype(_I32).tobytes()


def _cuts(x: np.ndarray):
    at = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True])
    return zip(at[:-1].tolist(), at[1:].tolist(), strict=True)


def _parsed(docs: DataFrame, length: int, count: int, buckets: int) -> DataFrame:
    """kind 0: anchors, dealt by key; kind 1: entries that a task itself has met twice, as marks."""
    bounds = np.array([(i << 64) // count for i in range(1, count)], np.uint64)

    def run(batches):
        cols, owner, doc, hashes, held = [], [], [], [], 0

        def sent():
            key, digest, at, lo, hi = (np.concatenate([c[k] for c in cols]) for k in range(5))
            own = np.repeat(np.array(owner), [len(c[0]) for c in cols])
            d, h = np.array(doc, _I64), np.array(hashes, _I64)
            order = np.lexsort((digest, key))
            same = np.r_[False, (key[order][1:] == key[order][:-1]) & (digest[order][1:] == digest[order][:-1])]
            group = np.cumsum(~same) - 1
            several = np.bincount(group)[group] > 1
            first = order[~same]
            more = several[~same].astype(_U8)
            if several.any():
                full = np.sort(order[several])  # back in the order of documents
                yield from _marks_of(own[full], d, h, lo[full], hi[full] + length, buckets, count)
            frag = np.searchsorted(bounds, key[first], "right")
            o = np.lexsort((own[first], frag))
            frag, first, more = frag[o], first[o], more[o]
            rows = []
            for a, b in _cuts(frag):
                i = first[a:b]
                rows.append(
                    (int(frag[a]), 0, *_by_owner(own[i], d, h), key[i].tobytes(), digest[i].tobytes(), at[i].astype(_I32).tobytes(), (at[i] - lo[i]).astype(_U8).tobytes(), (at[i] - hi[i]).astype(_U8).tobytes(), more[a:b].tobytes())
                )
            yield _rows(_PARSED, rows)

        for batch in batches:
            for i, h, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                i, h, fresh = i.as_py(), h.as_py(), True
                for found in anchors((text.as_py() or "").encode("utf-8", "surrogatepass"), length):
                    if fresh:
                        doc.append(_NULL if i is None else i)
                        hashes.append(h)
                        fresh = False
                    owner.append(len(doc) - 1)
                    cols.append(found)
                    held += len(found[0])
                    if held >= BLOCK:
                        yield from sent()
                        cols, owner, doc, hashes, held, fresh = [], [], [], [], 0, True
        if held:
            yield from sent()

    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(trimmed(run), _PARSED)


def _place(d: np.ndarray, h: np.ndarray, buckets: int) -> np.ndarray:
    return (h.view(np.uint64) % np.uint64(buckets)).astype(np.int64)


def _marks_of(own, d, h, s, e, buckets: int, count: int):
    """Repeated intervals as rows of kind 1; own is sorted. Those of a document that touch are united first."""
    far = int(e.max()) + 2
    s, e = _united(s + own * far, e + own * far)
    own = s // far
    s, e = s - own * far, e - own * far
    place = _place(d, h, buckets)[own]
    order = np.lexsort((own, place))
    own, place, s, e = own[order], place[order], s[order], e[order]
    rows = []
    for a, b in _cuts(place):
        none = b""
        rows.append((int(place[a]) % count, 1 + int(place[a]), *_by_owner(own[a:b], d, h), none, none, none, s[a:b].astype(_I32).tobytes(), e[a:b].astype(_I32).tobytes(), none))
    yield _rows(_PARSED, rows)


def _met(parsed: DataFrame, length: int, buckets: int) -> DataFrame:
    """Marks dealt by document: flag 0: repeated [lo, hi); 1 and 2: an entry to compare (2: repeated already)."""

    def run(batches):
        for _, rows in _groups(batches):
            out, parts = [], []
            for kind, *x in rows:
                if kind:
                    n = len(x[6]) // 4
                    out.append((kind - 1, x[0], x[1], x[2], x[6], x[7], bytes(4 * n), bytes(8 * n), bytes(n)))
                else:
                    parts.append(x)
            if out:
                yield _rows(_MARKS, out)
            if not parts:
                continue
            doc, h, n, key, digest, at, lo, hi, more = _arrays(parts, (_I64, _I64, _I32, _U64, _U64, _I32, _U8, _U8, _U8))
            own = np.repeat(np.arange(len(doc)), n)
            order = np.lexsort((digest, key))
            key, digest, own, at, lo, hi, more = (x[order] for x in (key, digest, own, at, lo, hi, more))
            at = at.astype(np.int64)
            lo, hi = at - lo, at - hi
            new_key = np.r_[True, key[1:] != key[:-1]]
            new = new_key | np.r_[True, digest[1:] != digest[:-1]]
            entry, k = np.cumsum(new) - 1, np.cumsum(new_key) - 1
            often = np.bincount(entry, weights=1 + more) > 1  # by entry
            entries = np.bincount(k, weights=new)  # by key
            open_ = np.bincount(k, weights=new & ~often[entry]) > 0  # a key with an entry met once
            whole = often[entry] & (more == 0)  # those with more are marked already
            compare = new & (entries[k] > 1) & open_[k]
            flag = np.where(often[entry], 2, 1) + np.where(entries[k] > MANY, 2, 0)
            sel = np.r_[np.flatnonzero(whole), np.flatnonzero(compare)]
            if not len(sel):
                continue
            flags = np.r_[np.zeros(whole.sum(), _U8), flag[compare].astype(_U8)]
            s, e = lo[sel], np.where(flags == 0, hi[sel] + length, hi[sel])
            o, place = own[sel], _place(doc, h, buckets)[own[sel]]
            order = np.lexsort((o, place))
            sel, flags, s, e, o, place = sel[order], flags[order], s[order], e[order], o[order], place[order]
            out = []
            for a, b in _cuts(place):
                i = sel[a:b]
                out.append((int(place[a]), *_by_owner(o[a:b], doc, h), s[a:b].astype(_I32).tobytes(), e[a:b].astype(_I32).tobytes(), at[i].astype(_I32).tobytes(), key[i].tobytes(), flags[a:b].tobytes()))
            yield _rows(_MARKS, out)

    return parsed.mapInArrow(trimmed(run), _MARKS)


_OF_DOC = "doc long, hash long, hot int, spans binary, lo binary, hi binary, at binary, key binary, flag binary"


def _of_documents(marks: DataFrame) -> DataFrame:
    """One row per marked document: its united spans (pairs of int), its entries to compare, and whether one has a hot key."""

    def run(batches):
        for _, parts in _groups(batches):
            doc, h, n, lo, hi, at, key, flag = _arrays(parts, (_I64, _I64, _I32, _I32, _I32, _I32, _U64, _U8))
            own = np.repeat(np.arange(len(doc)), n)
            order = np.lexsort((lo, h[own], doc[own]))
            d, hh = doc[own][order], h[own][order]
            lo, hi, at, key, flag = (x[order] for x in (lo, hi, at, key, flag))
            at_doc = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (hh[1:] != hh[:-1]), True])
            rows = []
            for a, b in zip(at_doc[:-1].tolist(), at_doc[1:].tolist(), strict=True):
                f = flag[a:b]
                z = f == 0
                s, e = _united(lo[a:b][z], hi[a:b][z])
                m = ~z
                rows.append((int(d[a]), int(hh[a]), int((f > 2).any()), np.stack([s, e], 1).astype(_I32).tobytes(), *(x[a:b][m].tobytes() for x in (lo, hi, at, key, flag))))
                if len(rows) == 2000:
                    yield _rows(_OF_DOC, rows)
                    rows = []
            if rows:
                yield _rows(_OF_DOC, rows)

    return marks.mapInArrow(trimmed(run), _OF_DOC)


def _anchors(columns):
    """(lo, hi, at, key, flag) of a document's anchors, some thousands of them in Python at a time."""
    arrays = [np.frombuffer(c, t) for c, t in zip(columns, (_I32, _I32, _I32, _I64, _U8), strict=True)]
    for k in range(0, len(arrays[0]), 5000):
        yield from zip(*(x[k : k + 5000].tolist() for x in arrays), strict=True)


def _entries(texts: DataFrame, length: int) -> DataFrame:
    """Entries to order, one row each: key, off (the trigger's place in it), flag, doc, hash, lo, entry."""
    schema = "key long, off int, flag int, doc long, hash long, lo int, entry binary"

    def run(batches):
        for batch in batches:
            rows = []
            for doc, h, text, *cols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for a, b, t, k, f in _anchors(cols):
                    if f < 3:
                        rows.append((k, t - a, f, doc, h, a, data[a : b + length]))
                    if len(rows) >= 5000:
                        yield _rows(schema, rows)
                        rows = []
            if rows:
                yield _rows(schema, rows)

    return texts.mapInArrow(trimmed(run), schema)


def _strings(texts: DataFrame, length: int) -> DataFrame:
    """The strings of entries with hot keys, one row each: id (their digest), doc, hash, lo, once (met once as an entry)."""
    schema = "id binary, doc long, hash long, lo int, once int"

    def run(batches):
        for batch in batches:
            rows = []
            for doc, h, text, *cols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for a, b, _, _, f in _anchors(cols):
                    if f > 2:
                        rows += [(xxhash.xxh3_128_digest(data[x : x + length]), doc, h, x, f % 2) for x in range(a, b + 1)]
                    if len(rows) >= 20_000:
                        yield _rows(schema, rows)
                        rows = []
            if rows:
                yield _rows(schema, rows)

    return texts.mapInArrow(trimmed(run), schema)


def _counted(strings: DataFrame, length: int) -> DataFrame:
    """Repeated strings: doc, hash, lo, hi. They are counted with partial sums and joined back, so that no task holds a
    string that many documents have."""
    strings = stage(strings, "dedup-strings")
    several = stage(strings.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "dedup-several")
    return strings.where("once = 1").join(several, "id", "left_semi").select("doc", "hash", "lo", (F.col("lo") + length).alias("hi"))


def parse_ranks(texts: list[bytes]) -> np.ndarray:
    """The rank of each text in their order, by the suffix array of their parse.

    Triggers cut the texts into phrases; distinct phrases are the dictionary, and its order gives their ranks. The
    suffixes of the parse are sorted by prefix doubling on these ranks; equal suffixes share a rank.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data, ends = b"".join(texts), np.cumsum(sizes)
    t = triggers(data)
    t = t[ends[np.searchsorted(ends, t, "right")] - t >= 8] if len(t) else t  # the bytes of a trigger lie in one text
    cuts = np.unique(np.r_[t, (ends - sizes)[sizes > 0]])
    owner = np.searchsorted(ends, cuts, "right")
    upto = np.minimum(np.r_[cuts[1:], len(data)] + 8, ends[owner])  # with the trigger at its end no phrase starts another
    phrases = [data[x:y] for x, y in zip(cuts.tolist(), upto.tolist(), strict=True)]
    place = {p: k for k, p in enumerate(sorted(set(phrases)))}
    rank = np.fromiter(map(place.__getitem__, phrases), np.int64, len(phrases))
    step, many = 1, -1
    while len(rank) and step < len(rank):
        after = np.zeros(len(rank), np.int64)
        same = np.flatnonzero(owner[step:] == owner[:-step])
        if not len(same):
            break
        after[same] = rank[same + step] + 1
        distinct, rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)
        if len(distinct) == many and step > 1:
            break  # no suffix was told apart from another
        step, many = 2 * step, len(distinct)
    out = np.full(len(texts), -1, np.int64)  # an empty text comes first
    out[sizes > 0] = rank[np.searchsorted(cuts, (ends - sizes)[sizes > 0])]
    return out


def common_prefixes(texts: list[bytes], order: np.ndarray) -> np.ndarray:
    """For neighbours in the order, how many bytes they have in common from the start."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    wide = int(sizes.max(initial=0)) + 1
    table = np.zeros((len(texts), wide), np.int16)
    inside = np.arange(wide) < sizes[:, None]
    table[inside] = np.frombuffer(b"".join(texts), np.uint8)
    table[~inside] = -1
    table = table[order]
    differ = (table[1:] != table[:-1]) | (table[1:] < 0)
    return differ.argmax(axis=1)


def corpus_order(entries: list[bytes], offs: np.ndarray, length: int) -> np.ndarray:
    """hit[i, d]: the string of `length` bytes that starts d bytes before entry i's trigger (at offs[i]) starts in another
    entry too. Equal strings have their first trigger at the same distance.

    What follows the triggers is ordered by the suffix array of the parse, what precedes them by the order of the
    dictionary's suffixes (read backwards from the trigger). A string is its part before the trigger and its part from it
    on, so strings are equal where they lie together in both orders, by common prefixes of d and of length - d bytes.
    """
    n, sizes = len(entries), np.fromiter(map(len, entries), np.int64, len(entries))
    rights = [e[o:] for e, o in zip(entries, offs.tolist(), strict=True)]
    lefts = [e[:o][::-1] for e, o in zip(entries, offs.tolist(), strict=True)]
    right = np.argsort(parse_ranks(rights), kind="stable")
    known = {x: k for k, x in enumerate(sorted(set(lefts)))}
    left = np.argsort(np.fromiter(map(known.__getitem__, lefts), np.int64, n), kind="stable")
    after, back = common_prefixes(rights, right), common_prefixes(lefts, left)
    least = offs - (sizes - length)  # the entry's last start
    hit = np.zeros((n, int(offs.max(initial=0)) + 1), bool)
    a, b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in range(hit.shape[1]):
        some = np.flatnonzero((least <= d) & (d <= offs))
        if len(some) > 1:
            a[left] = np.r_[0, np.cumsum(back < d)]
            b[right] = np.r_[0, np.cumsum(after < length - d)]
            _, at, count = np.unique(a[some] * n + b[some], return_inverse=True, return_counts=True)
            hit[some, d] = count[at] > 1
    return hit


def _compared(entries: DataFrame, length: int) -> DataFrame:
    """Repeated strings of entries that the parse has once: doc, hash, lo, hi."""
    schema = "doc long, hash long, lo int, hi int"

    def found(rows):
        """rows: whole keys, one after the other."""
        hit = corpus_order([r[5] for r in rows], np.array([r[0] for r in rows]), length)
        hit[[r[1] % 2 == 0 for r in rows]] = False  # flag 1: met once
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (i, near), (_, far) = np.nonzero(edge == 1), np.nonzero(edge == -1)  # runs of distances near..far - 1
        return [(rows[k][2], rows[k][3], rows[k][4] + rows[k][0] - y + 1, rows[k][4] + rows[k][0] - x + length) for k, x, y in zip(i.tolist(), near.tolist(), far.tolist(), strict=True)]

    def run(batches):
        held, size = [], 0
        for _, rows in _groups(batches):
            if len(rows) > 1:  # a string that starts elsewhere too starts in another entry of its key
                held += rows
                size += sum(len(r[5]) for r in rows)
            if size > ORDER:
                if out := found(held):
                    yield _rows(schema, out)
                held, size = [], 0
        if held and (out := found(held)):
            yield _rows(schema, out)

    return entries.mapInArrow(trimmed(run), schema)


def marked_documents(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, bool]:
    """(rows doc, hash, spans binary, more array<struct<lo, hi>>) per document with repeated bytes; small: may be broadcast."""
    parts = width(docs.sparkSession)
    count = max(1, min(FRAGMENTS, docs.count() // DOCS_PER_FRAGMENT))
    buckets = count
    wide = max(parts, min(count, PARTITIONS))
    parsed = _parsed(docs, length, count, buckets).repartition(wide, "frag").sortWithinPartitions("frag")
    met = _met(parsed, length, buckets).repartition(wide, "bucket").sortWithinPartitions("bucket")
    marks = stage(_of_documents(met), "dedup-marks")
    unsure = marks.where(F.octet_length("flag") > 0)
    texts = _with_text(docs, unsure, unsure.count() <= BROADCAST_DOCS).select("doc", "hash", _text(), "lo", "hi", "at", "key", "flag")
    entries = _entries(texts, length).repartition(wide, "key").sortWithinPartitions("key", "doc", "hash", "lo")
    found = _compared(entries, length)
    hot = marks.where("hot = 1")
    if many := hot.count():  # keys with many entries: their strings one by one
        texts = _with_text(docs, hot, many <= BROADCAST_DOCS).select("doc", "hash", _text(), "lo", "hi", "at", "key", "flag")
        found = found.union(_counted(_strings(texts, length), length))
    more = found.groupBy("doc", "hash").agg(F.collect_list(F.struct("lo", "hi")).alias("more"))
    out = marks.select("doc", "hash", "spans").join(more, ["doc", "hash"], "left").where((F.octet_length("spans") > 0) | F.col("more").isNotNull())
    out = stage(out, "dedup-spans")
    return out, out.count() <= BROADCAST_DOCS


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, doc, hash): whole rows, so that further columns may have any names."""
    return docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(_NULL)).alias("doc"), F.xxhash64("text").alias("hash"))


def _text():
    return F.coalesce(F.col("row.text"), F.lit("")).alias("text")


def _with_text(docs: DataFrame, marks: DataFrame, small: bool) -> DataFrame:
    """marks joined with their documents; if their list is small, other texts are dropped before the shuffle."""
    keyed = _keyed(docs)
    if small:
        keyed = keyed.join(F.broadcast(marks.select("doc", "hash")), ["doc", "hash"], "left_semi")
    return keyed.hint("merge").join(marks, ["doc", "hash"])


def _without_marks(docs: DataFrame, marks: DataFrame, small: bool) -> DataFrame:
    ids = marks.select("doc", "hash")
    return _keyed(docs).join(F.broadcast(ids) if small else ids, ["doc", "hash"], "left_anti")


def _spans(spans: bytes, more) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(spans, _I32).reshape(-1, 2).astype(np.int64)
    y = np.array([(m["lo"], m["hi"]) for m in (() if more is None else more)], np.int64).reshape(-1, 2)
    return _united(np.r_[x[:, 0], y[:, 0]], np.r_[x[:, 1], y[:, 1]])


def _kept(data: bytes, s: np.ndarray, e: np.ndarray) -> bytes:
    return b"".join(data[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(data)], strict=True))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = docs.select("doc_id", "text")
    marks, small = marked_documents(docs, length)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, spans, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                s, e = _spans(spans, more)
                rows.append((doc, len(data), int((e - s).sum()), len(s), hashlib.sha256(_kept(data, s, e)).hexdigest()))
            types = [*[pa.int64()] * 4, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types], names=[x.split()[0] for x in schema.split(", ")])

    cut = _with_text(docs, marks, small).select(F.col("row.doc_id"), _text(), "spans", "more").mapInArrow(trimmed(run), schema)
    zero = F.lit(0).cast("long")
    whole = _without_marks(docs, marks, small).select("row.doc_id", F.octet_length(_text()).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(_text(), 256).alias("kept_sha256"))
    return cut.union(whole)


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with repeated passages cut from the texts; n_chars, if there, is counted anew."""
    marks, small = marked_documents(docs.select("doc_id", "text"), length)

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array, more: pa.Array) -> pa.Array:
        rows = zip(text.to_pylist(), spans.to_pylist(), more.to_pylist(), strict=True)
        return pa.array([_kept(t.encode("utf-8", "surrogatepass"), *_spans(s, m)).decode("utf-8", "ignore") for t, s, m in rows], pa.string())

    def back(rows: DataFrame) -> DataFrame:
        new = {"text": F.col("new"), "n_chars": F.char_length("new").cast(dict(docs.dtypes).get("n_chars", "long"))}
        return rows.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])

    changed = back(_with_text(docs, marks, small).select("row", cut(_text(), "spans", "more").alias("new")))
    return changed.union(_without_marks(docs, marks, small).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
