"""Phrase collocations from vertical positional inverted lists.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words; all is per language. The
list of a phrase holds the positions where it starts. Level by level, the lists of frequent phrases are merge-joined with
the postings of the words that stand just behind them; a list's length is the phrase's frequency. Lists are kept per block
of texts: what leaves a block is a phrase's hash and the length of its list, and `tally` adds these up, so frequencies
are exact and no list is gathered. A phrase that isn't frequent has no frequent extension, so only those whose first and
last words (all but one) are frequent phrases are asked for.

Score of a phrase with frequency a: over its cuts into a first part and the rest, with frequencies l and r among n words,
the least floor(1000 * a * n / (l * r)); of equal cuts the first. A phrase is dropped if a longer one that contains it
comes as often: then the one that is a word longer and lies between them does as well, so these are enough to look at.

Phrases are told apart by 64-bit hashes while they are counted.

Defined cases: null text has no words; null lang is `und`, together with that name; a text of any length is a block of its
own beyond BLOCK bytes; repeated rows count each; a language without candidates and an empty table give no rows; further
columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, width
from .shingles import mixed
from .tally import ASKS, asked, blocked, each_block, fragments_for, packed, rows, totals, unpacked
from .words import blocks, joined, release, spelled, trimmed

#: Words of the longest phrases, the least frequency, and the phrases of a language that are returned.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of text in a block, about.
BLOCK = 8_000_000
#: The characters that end a piece.
BREAKS = ".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, every break as a full stop.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS.encode(), b"abcdefghijklmnopqrstuvwxyz" + b"." * len(BREAKS))
_ODD = np.uint64(0x9E3779B97F4A7C15)

_TABLE = "block long, words long, langs string, spelling binary, word_of binary, lang_of binary, text binary"


def _broken(text: str | None) -> str:
    """The text in lower case, with a full stop between blanks for each end of a piece, and one at its end."""
    return ((text or "").encode() + b".").translate(_PLAIN).replace(b".", b" . ").decode()


def _blocks_of(docs: DataFrame) -> DataFrame:
    """One row per block: its languages, distinct words (once per language) and texts as places among these, from 1; 0 is a break."""

    def run(batches):
        turn = TaskContext.get().partitionId() << 24
        for batch in joined(batches, BLOCK):
            for a, b in blocks(batch.column(1), BLOCK):
                offsets, index, words = spelled(pa.array([_broken(t.as_py()) for t in batch.column(1).slice(a, b - a)], pa.large_string()))
                langs = batch.column(0).slice(a, b - a).dictionary_encode()
                of = np.repeat(langs.indices.to_numpy().astype(np.int64), np.diff(offsets))
                stop = pc.index(words, pa.scalar(".", words.type)).as_py()
                inner = index != stop
                pairs, at, n = np.unique(of[inner] * len(words) + index[inner], return_inverse=True, return_counts=True)
                order = np.argsort(-n, kind="stable")
                place = np.empty(len(pairs), np.int32)
                place[order] = np.arange(1, len(pairs) + 1)
                text = np.zeros(len(index), np.int32)
                text[inner] = place[at]
                spelling = zstandard.ZstdCompressor(level=3).compress("\n".join(words.to_pylist()).encode())
                row = (turn, int(inner.sum()), json.dumps(langs.dictionary.to_pylist()), spelling, packed((pairs[order] % len(words)).astype(np.int32)), packed((pairs[order] // len(words)).astype(np.int32)), packed(text))
                turn += 1
                yield rows([row], _TABLE).to_batches()[0]

    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    return blocked(docs.select(lang, "text").mapInArrow(trimmed(run), _TABLE), "phrases")


class Lists:
    """The inverted lists of a block. Level n has phrases of n words: their keys, the lengths of their lists, and once they were
    answered, their totals over all blocks. The lists of frequent phrases are kept merged, in order of position (`places`,
    `at` has the phrase of each), so that joining them with postings is one merge."""

    def __init__(self, block: pa.Table):
        row = block.to_pylist()[0]
        self.id = row["block"]
        self.langs = json.loads(row["langs"])
        self.words = zstandard.ZstdDecompressor().decompress(row["spelling"]).decode().split("\n")
        self.word_of, self.lang_of, self.text = (unpacked(row[k], np.int32) for k in ("word_of", "lang_of", "text"))
        spelled_ = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.lang_keys = np.fromiter((xxhash.xxh3_64_intdigest(x, 1) for x in self.langs), np.uint64, len(self.langs))
        with np.errstate(over="ignore"):
            word_keys = mixed(spelled_[self.word_of] + self.lang_keys[self.lang_of] * _ODD) if len(self.word_of) else spelled_[:0]
        self.keys, self.length, self.total, self.own, self.places, self.at = {}, {}, {}, {}, {}, {}
        where = np.flatnonzero(self.text)
        self._listed(1, word_keys, where, self.text[where] - 1)

    def _listed(self, n: int, keys: np.ndarray, places: np.ndarray, phrase: np.ndarray) -> None:
        self.keys[n], self.places[n], self.at[n] = keys, places, np.full(len(self.text) + LONGEST, -1, np.int32)
        self.at[n][places] = phrase
        self.length[n] = np.bincount(phrase, minlength=len(keys))

    def _frequent(self, n: int) -> None:
        """Drop the lists of phrases that aren't frequent."""
        phrase = self.at[n][self.places[n]]
        often = self.total[n][phrase] > 0
        self.at[n][self.places[n][~often]] = -1
        self.places[n] = self.places[n][often]
        self.length[n] = np.where(self.total[n] > 0, self.length[n], 0)

    def extend(self) -> None:
        """The next level: the lists, merged by position, meet the postings of the words just behind their phrases."""
        n = len(self.places) + 1
        start, postings = self.places[n - 1], self.places[1]
        behind = np.searchsorted(postings, start + n - 1)
        hit = (behind < len(postings)) & (np.append(postings, -1)[behind] == start + n - 1)
        hit &= self.at[n - 1][start + 1] >= 0  # all but the first word are frequent too
        start = start[hit]
        size = len(self.word_of) + 1
        pairs, of = np.unique(self.at[n - 1][start].astype(np.int64) * size + self.at[1][start + n - 1], return_inverse=True)
        with np.errstate(over="ignore"):
            keys = mixed(self.keys[n - 1][pairs // size] * _ODD + self.keys[1][pairs % size])
        self._listed(n, keys, start, of)

    def ask(self, fragments: int) -> pa.Table:
        n = len(self.places)
        order = np.argsort(self.keys[n], kind="stable")
        keys, counts = self.keys[n][order], self.length[n][order]
        found = asked(self.id, n, keys, counts, np.zeros(len(keys)), fragments)
        if n == 1:  # the words of each language
            order = np.argsort(self.lang_keys)
            found += asked(self.id, 0, self.lang_keys[order], np.bincount(self.lang_of, self.length[1], len(self.langs))[order], np.zeros(len(order)), fragments)
        return rows(found, ASKS)

    def hear(self, answers: dict[int, np.ndarray], levels: int) -> None:
        for n in range(levels + 1):
            keys = self.keys[n] if n else self.lang_keys
            order = np.argsort(keys, kind="stable")
            self.total[n], self.own[n] = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
            if len(order):
                self.total[n][order] = (answers[n] >> np.uint64(1)).astype(np.int64)
                self.own[n][order] = answers[n] & np.uint64(1) > 0
            if n:
                self._frequent(n)
                if n < LONGEST:
                    self.extend()

    def candidates(self) -> pa.Table:
        """The block's own frequent phrases of two words or more, with the frequencies of both parts of every cut."""
        found = []
        for n in range(2, LONGEST + 1):
            places = self.places[n]
            phrase, first = np.unique(self.at[n][places], return_index=True)
            for i, p in zip(phrase.tolist(), places[first].tolist(), strict=True):
                if not self.own[n][i]:
                    continue
                pair = [int(self.at[1][p + k]) for k in range(n)]
                part = lambda q, m: int(self.total[m][self.at[m][q]])
                lang = int(self.lang_of[pair[0]])
                found.append((self.langs[lang], " ".join(self.words[self.word_of[x]] for x in pair), n, int(self.total[n][i]), int(self.total[0][lang]), [part(p, k) for k in range(1, n)], [part(p + k, n - k) for k in range(1, n)]))
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        columns = zip(*found, strict=True) if found else [[]] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "phrase", "size", "a", "n", "ls", "rs"])


def candidates(docs: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, n, ls, rs): every phrase of two to LONGEST words that comes LEAST times or more, staged."""
    table = _blocks_of(docs)
    words = table.agg(F.sum("words")).first()[0] or 0
    answers: list[DataFrame] = []
    for n in range(1, LONGEST + 1):
        fragments = fragments_for(words // (4 if n == 1 else 2))

        def ask(block: pa.Table, there: dict[int, np.ndarray], fragments: int = fragments, known: int = n - 1) -> pa.Table:
            lists = Lists(block)
            if known:
                lists.hear(there, known)
            out = lists.ask(fragments)
            release()
            return out

        answers.append(totals(each_block(table, answers, ask, ASKS), fragments, f"phrases-{n}", LEAST))

    def own(block: pa.Table, there: dict[int, np.ndarray]) -> pa.Table:
        lists = Lists(block)
        lists.hear(there, LONGEST)
        out = lists.candidates()
        release()
        return out

    return stage(each_block(table, answers, own, "lang string, phrase string, size int, a long, n long, ls array<long>, rs array<long>"), "phrases")


def scored(found: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their lowest cut; products are exact decimals."""
    wide = lambda c: c.cast("decimal(38,0)")
    cut = lambda l, k: F.struct(F.call_function("div", wide(F.lit(1000)) * wide(F.col("a")) * wide(F.col("n")), wide(l) * wide(F.get("rs", k))).alias("score"), k.alias("k"), l.alias("l"), F.get("rs", k).alias("r"))
    return found.withColumn("cut", F.array_min(F.transform("ls", cut))).select("*", "cut.l", "cut.r", "cut.score").drop("cut")


def contained(found: DataFrame) -> DataFrame:
    """(lang, phrase) that lie in a phrase a word longer with the same frequency."""
    longer = found.where("size > 2")
    short: list[Column] = [F.when(F.element_at("ls", -1) == F.col("a"), F.call_function("substring_index", "phrase", F.lit(" "), F.col("size") - 1)), F.when(F.col("rs")[0] == F.col("a"), F.call_function("substring_index", "phrase", F.lit(" "), 1 - F.col("size")))]
    return longer.select("lang", F.explode(F.array(*short)).alias("phrase")).where("phrase is not null").distinct()


def collocations(docs: DataFrame) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the TOP phrases of each language by score, then a, then the phrase."""
    found = candidates(docs)
    left = scored(found.join(contained(found), ["lang", "phrase"], "left_anti"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share of a language, then of these: no task sees a whole language
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(width(docs.sparkSession)))).orderBy(*order)
    few = left.withColumn("place", F.row_number().over(share)).where(F.col("place") <= TOP)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= TOP)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
