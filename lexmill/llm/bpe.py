"""BPE encoding and decoding by prefix-sharing trie traversal.

A vocabulary with ranked merges over the bytes of words, the last symbol carrying the end-of-word mark. The encoding of
a string ends in exactly one token whose left part is again an encoding, so it is enough to know the last token of each
prefix. Distinct words are walked in sorted order, which is a depth-first traversal of their trie: the stack holds the
last-token state of each prefix, and a prefix shared by many words is computed once. A candidate token may follow the
prefix's last token if no merge crosses their boundary before both are complete.

Defined cases: null text is empty and has no tokens (digests of the empty string); texts may be of any length; repeated
rows are encoded each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from .words import blocks, gathered, joined, release, spelled, trimmed

#: Pairs of tokens of which it is remembered, per Python worker, whether they may stand side by side.
PAIRS = 300_000
#: Bytes of text encoded together by the trie: the more, the more prefixes are shared.
BLOCK = 16_000_000
END = "</w>"
#: ASCII punctuation without the apostrophe, which may belong to the letters before it.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in the vocabulary: itself if printable, else from U+0100 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class WordBPE:
    """The encoder of one vocabulary file. Words are handled as str with one character per byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, of = spec["model"], byte_symbols()
        self.symbols = of
        self.tokens = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for t, i in model["vocab"].items():
            if t not in self.special:
                kind, body = (self.final, t.removesuffix(END)) if t.endswith(END) else (self.inner, t)
                kind["".join(chr(of[c]) for c in body)] = i
        self.longest = max(map(len, [*self.inner, *self.final]))
        vocab = model["vocab"]
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(model["merges"]):
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.rank[i << 20 | j] = r
            self.parts.setdefault(k, (r, i, j))
        self.spines: dict[tuple[int, bool], list[tuple[int, int, int]]] = {}
        self.fits: dict[int, bool] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def spine(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(token, rank that makes it, rank that uses it up) of the parts at one edge, from the whole downwards."""
        out = self.spines.get((token, right))
        if out is None:
            out, t, used = [], token, 1 << 30
            while t in self.parts:
                r, a, b = self.parts[t]
                out.append((t, r, used))
                t, used = (b if right else a), r
            out.append((t, -1, used))
            self.spines[token, right] = out
        return out

    def fit(self, a: int, b: int) -> bool:
        """Whether encoding the two tokens' strings together gives just these two tokens."""
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            known, rank = True, self.rank
            for x, made_x, used_x in self.spine(a, True):
                for y, made_y, used_y in self.spine(b, False):
                    r = rank.get(x << 20 | y)
                    # equal ranks: the leftmost pair merges first
                    if r is not None and r < used_x and r <= used_y and made_x < used_y and made_y < used_x:
                        known = False
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[key] = known
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of distinct words (one character per byte), by one walk of their trie."""
        inner, final, longest, fits, fit = self.inner, self.final, self.longest, self.fits, self.fit
        last: list[int] = [-1]  # last token of the prefix of each length on the path
        size: list[int] = [0]
        out, path = {}, ""
        for w in sorted(words):
            n, d, top = len(w), 0, min(len(w) - 1, len(path))
            while d < top and w[d] == path[d]:
                d += 1
            del last[d + 1 :], size[d + 1 :]
            for at in range(d + 1, n):  # states of the new prefixes
                for k in range(min(at, longest), 0, -1):
                    t = inner.get(w[at - k : at])
                    if t is not None:
                        p = last[at - k]
                        if p < 0 or (f if (f := fits.get(p << 20 | t)) is not None else fit(p, t)):
                            last.append(t)
                            size.append(k)
                            break
            path = w[: n - 1] if n else ""
            for k in range(min(n, longest), 0, -1):
                t = final.get(w[n - k :])
                if t is not None:
                    p = last[n - k]
                    if p < 0 or (f if (f := fits.get(p << 20 | t)) is not None else fit(p, t)):
                        ids, at = [t], n - k
                        while at:
                            ids.append(last[at])
                            at -= size[at]
                        out[w] = ids[::-1]
                        break
        return out

    def words_of(self, chunk: str) -> list[str | int]:
        """Words (one character per byte) and ids of special tokens in a chunk."""
        if "<|" in chunk and self.split_special and self.split_special.search(chunk):
            out, at = [], 0
            for m in self.split_special.finditer(chunk):
                out += [*self.words_of_plain(chunk[at : m.start()]), self.special[m[0]]]
                at = m.end()
            return out + self.words_of_plain(chunk[at:])
        return self.words_of_plain(chunk)

    def words_of_plain(self, chunk: str) -> list[str]:
        if chunk.isascii():
            return self.cut.findall(chunk.lower())
        if max(chunk) >= "\u0250":  # the library's version of Unicode decides
            words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
            return ["".join(chr(self.symbols[c]) for c in w) for w, _ in words]
        chunk = unicodedata.normalize("NFC", chunk).lower()
        return [w.encode().decode("latin-1") for w in self.cut.findall(chunk)]

    def decode(self, ids: Iterable[int]) -> str:
        """As the library decodes without a decoder: tokens joined by one space."""
        return " ".join(self.tokens[int(i)] for i in ids)


class TextEncoder:
    """Texts to the token ids of their words between white space, each distinct word encoded once a block.

    No token crosses white space, so a text's ids are those of its words in turn. Words are encoded by the trie, or by
    the tokenizers library itself (`library`).
    """

    def __init__(self, path: str, library: bool = False):
        self.bpe = WordBPE(path)
        self.library = self.bpe.library if library else None
        self.split = Tokenizer(self.bpe.library.model)  # words that are pieces already, between spaces
        self.split.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.before: tuple[dict[str, int], np.ndarray, np.ndarray] = {}, np.zeros(0, np.int64), np.zeros(0, np.uint32)
        top = max(self.bpe.tokens) + 1
        self.ends = np.zeros(top, bool)  # tokens that end a piece of a word
        self.ends[list(self.bpe.final.values())] = True
        self.contents = pa.array([self.bpe.tokens.get(i, "") for i in range(top)], pa.large_string())
        self.numbers = pa.array([str(i) for i in range(top)], pa.large_string())

    def learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids): how many ids each distinct chunk has, and all of them in turn. Chunks of the block before are known."""
        index, sizes, flat = self.before
        known = np.fromiter(map(index.get, chunks, repeat(-1)), np.int64, len(chunks))
        new_sizes, new_flat = self.encode([chunks[k] for k in np.flatnonzero(known < 0).tolist()])
        known[known < 0] = len(sizes) + np.arange(len(new_sizes))
        sizes = np.r_[sizes, new_sizes]
        flat = gathered(known, sizes, np.r_[flat, new_flat])
        self.before = {c: k for k, c in enumerate(chunks)}, sizes[known], flat
        return sizes[known], flat

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, np.uint32)
        if not self.library:
            parts = [self.bpe.words_of(c) for c in chunks]
            words = self.bpe.encode_words({w for p in parts for w in p if w.__class__ is str})
            ids = [[i for w in p for i in (words[w] if w.__class__ is str else (w,))] for p in parts]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        # letters of Latin-1 are one piece, punctuation behind them another; each ends with the one token that may end it,
        # and only they need no normalizer. Others are cut by a special token put between them; those that might hold
        # one go alone.
        bare = [c.rstrip(PUNCTUATION) for c in chunks]
        plain = [b.isalpha() and (b.isascii() or max(b) < "\u0100") for b in bare]
        kinds = np.array([2 if "<|" in c else 0 if p else 1 for c, p in zip(chunks, plain, strict=True)], np.int8)
        order = np.argsort(kinds, kind="stable")
        bound = np.searchsorted(kinds[order], [1, 2]).tolist()
        first, others, alone = (x.tolist() for x in np.split(order, bound))
        mark, mark_id = next(iter(self.bpe.special.items()))

        pieces = np.fromiter((1 + (len(bare[k]) < len(chunks[k])) for k in first), np.int64, len(first))
        words = [bare[k].lower() if n == 1 else f"{bare[k].lower()} {chunks[k][len(bare[k]):]}" for k, n in zip(first, pieces.tolist(), strict=True)]
        flat = self._ids(self.split, [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)])
        ends = np.flatnonzero(self.ends[flat])
        if len(ends) != pieces.sum():
            raise ValueError("the vocabulary's pieces can't be told apart")
        sizes, ids = [np.diff(ends[np.cumsum(pieces) - 1], prepend=-1)], [flat]

        flat = self._ids(self.library, [mark.join(chunks[k] for k in others[i : i + 1000]) + mark for i in range(0, len(others), 1000)])
        ends = np.flatnonzero(flat == mark_id)
        sizes.append(np.diff(ends, prepend=-1) - 1)
        ids.append(np.delete(flat, ends))
        for k in alone:
            ids.append(self._ids(self.library, [chunks[k]]))
            sizes.append(np.array([len(ids[-1])]))
        size, back = np.concatenate(sizes), np.empty(len(chunks), np.int64)
        back[order] = np.arange(len(chunks))
        return size[back], gathered(back, size, np.concatenate(ids))

    @staticmethod
    def _ids(encoder: Tokenizer, texts: list[str]) -> np.ndarray:
        parts = [np.zeros(0, np.uint32)]
        for k in range(0, len(texts), 20):  # an encoding takes many times the memory of its ids
            parts += [np.array(e.ids, np.uint32) for e in encoder.encode_batch_fast(texts[k : k + 20], add_special_tokens=False)]
        return np.concatenate(parts)

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ids[offsets[i]:offsets[i + 1]]."""
        offsets, index, words = spelled(texts)
        sizes, flat = self.learn(words.to_pylist())
        return np.r_[0, np.cumsum(sizes[index])][offsets], gathered(index, sizes, flat)

    def rendered(self, table: pa.Array, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The entries of a table by id, joined by one space for each text."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table.take(pa.array(ids))), pa.scalar(" ", table.type))


@lru_cache(2)
def text_encoder(path: str, library: bool = False) -> TextEncoder:
    """Kept for the next tasks of a worker: the vocabulary, what joins its tokens, and the words of one block."""
    out = TextEncoder(path, library)
    release()  # of what reading the vocabulary took
    return out


def slices(texts: pa.Array) -> Iterator[memoryview]:
    """The bytes of a large string array's values, not copied."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    raw = memoryview(texts.buffers()[2] or b"")
    return (raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def encoded(docs: DataFrame, path: str, keep_ids: bool = True) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) and, if keep_ids, ids binary and decoded string."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary, decoded string" if keep_ids else "")

    def run(batches):
        enc = text_encoder(path)
        for batch in joined(batches, BLOCK):
            for a, b in blocks(batch.column(1), BLOCK):
                offsets, ids = enc.block(batch.column(1).slice(a, b - a))
                numbers, words = enc.rendered(enc.numbers, offsets, ids), enc.rendered(enc.contents, offsets, ids)
                sha = [pa.array([hashlib.sha256(x).hexdigest() for x in slices(t)], pa.string()) for t in (numbers, words)]
                cols = [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets), pa.int64()), *sha]
                if keep_ids:
                    raw = ids.astype("<u4").tobytes()
                    cols += [pa.array([raw[4 * x : 4 * y] for x, y in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()), words.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, schema=out_schema)

    out_schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + ([("ids", pa.binary()), ("decoded", pa.string())] if keep_ids else []))
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), schema)
