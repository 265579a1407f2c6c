"""Language-model scoring with a weighted backoff automaton.

Model: n-grams of up to ORDER tokens (lower-cased words; every text starts with a mark that is not scored and ends with
an end token) with Jelinek-Mercer smoothing. With h the context, h' the context without its first token, and b the binary
magnitude of c(h):

    P(w | h) = w_b * c(hw) / c(h) + (1 - w_b) * P(w | h'),    w_b = tokens again / (tokens + 1)

where, over all contexts of that order and magnitude, `tokens` are the training tokens that follow them and `tokens again`
those whose n-gram comes more than once: how often it would still be known with this occurrence left out. Without a context
it is the same over all tokens, and the rest is the probability of the one unknown word. So the sum over the known words
and the unknown one is 1 in every state.

Automaton: states are contexts, an arc per seen n-gram carries log10 P and leads to the longest context that the text then
ends with, a failure arc carries log10(1 - w_b) and leads to the shorter context. Contexts that come once have w_b = 0
and are no states. A text is one run from left to right: where the state has no arc for the token, failure
arcs are followed first.

Scale: counts come from `tally`, one level after the other; a block of texts gets exactly the states and arcs that its own
texts can reach, in memory that the block bounds. The model is nowhere whole; what is shuffled grows with the input.

Defined cases: null text is empty and is scored as its end token; null doc_ids aren't held out; repeated rows count and are
scored each; a model without training rows gives every token the probability 1/(V + 1) = 1; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mixed
from .tally import ASKS, asked, blocked, each_block, fragments_for, packed, rows, steps, sums_of, totals, unpacked
from .words import blocks, joined, release, spelled, trimmed

#: Tokens of the longest n-grams.
ORDER = 3
#: Bytes of text in a block, about.
BLOCK = 8_000_000
#: A document is held out if crc32(doc_id as text) mod FOLDS is 0.
FOLDS = 10
END, START = np.uint64(0x51ED270B35A3A6F1), np.uint64(0xA0761D6478BD642F)
_ODD = np.uint64(0x9E3779B97F4A7C15)

_TABLE = "block long, tokens long, ids binary, known binary, held binary, sizes binary, words binary, text binary"


def _blocks_of(docs: DataFrame) -> DataFrame:
    """One row per block: documents, the hashes of its distinct words (the frequent first), and its texts as places there."""

    def run(batches):
        turn = TaskContext.get().partitionId() << 24
        for batch in joined(batches, BLOCK):
            for a, b in blocks(batch.column(2), BLOCK):
                offsets, index, words = spelled(batch.column(2).slice(a, b - a), lower=True)
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
                order = np.lexsort((h, -np.bincount(index, minlength=len(h))))
                place = np.empty(len(h), np.int32)
                place[order] = np.arange(len(h), dtype=np.int32)
                ids = batch.column(0).slice(a, b - a)
                row = (turn, len(index) + b - a, packed(ids.fill_null(0).to_numpy()), packed(ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)), packed(batch.column(1).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.uint8)),
                       packed(np.diff(offsets).astype(np.int32)), packed(steps(h[order])), packed(place[index]))
                turn += 1
                yield rows([row], _TABLE).to_batches()[0]

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return blocked(docs.select("doc_id", held.alias("held"), "text").mapInArrow(trimmed(run), _TABLE), "lm")


class Block:
    """The texts of a block as one stream of tokens (places in `hashes`), with the n-grams found in it, level by level.

    of[n][p]: the n-gram that starts at p, as a place in keys[n], or -1 where none is counted there.
    """

    def __init__(self, block: pa.Table):
        row = block.to_pylist()[0]
        self.id = row["block"]
        self.ids, self.known, self.held, self.sizes = (unpacked(row[k], t) for k, t in (("ids", np.int64), ("known", np.uint8), ("held", np.uint8), ("sizes", np.int32)))
        words = np.cumsum(unpacked(row["words"], np.uint64), dtype=np.uint64)
        text = unpacked(row["text"], np.int32)
        self.end, self.start = len(words), len(words) + 1
        length = self.sizes.astype(np.int64) + 2
        self.to = np.cumsum(length)
        self.at = self.to - length
        stream = np.zeros(int(self.to[-1]), np.int32)
        inner = np.ones(len(stream), bool)
        inner[self.at] = inner[self.to - 1] = False
        stream[inner] = text
        stream[self.at], stream[self.to - 1] = self.start, self.end
        self.stream = stream
        self.train = np.repeat(self.held == 0, length)
        self.keys = {1: np.r_[words, END, START]}
        self.of = {1: stream}
        self.total: dict[int, np.ndarray] = {}
        self.context: dict[int, np.ndarray] = {}
        self.first: dict[int, np.ndarray] = {}

    def grow(self) -> None:
        """The next level: the n-grams that follow the states of this one."""
        n = len(self.of) + 1
        before = self.of[n - 1]
        state = self.states(n - 1)
        p = np.flatnonzero((before[: len(before) - 1] >= 0) & (self.stream[n - 2 : -1] != self.end))
        p = p[state[before[p]]]
        pair, first, of = np.unique(before[p].astype(np.int64) * (self.start + 1) + self.stream[p + n - 1], return_index=True, return_inverse=True)
        here = np.full(len(self.stream) - n + 1, -1, np.int32)
        here[p] = of
        last = pair % (self.start + 1)
        self.context[n], self.first[n] = (pair // (self.start + 1)).astype(np.int32), p[first]
        with np.errstate(over="ignore"):
            self.keys[n] = mixed(self.keys[n - 1][self.context[n]] * _ODD + self.keys[1][last])
        self.of[n] = here

    def states(self, n: int) -> np.ndarray:
        """Which n-grams are contexts of longer ones."""
        return self.total[n] > 1

    def reached(self, n: int, gram: np.ndarray) -> np.ndarray:
        """Whether the given n-grams (-1: none) are states."""
        return np.append(self.states(n), False)[gram]

    def seen(self, n: int, gram: np.ndarray) -> np.ndarray:
        """Whether the given n-grams (-1: none) come in training texts."""
        return np.append(self.total[n] > 0, False)[gram]

    def counts(self, n: int) -> np.ndarray:
        here = self.of[n]
        return np.bincount(here[(here >= 0) & self.train[: len(here)]], minlength=len(self.keys[n]))

    def tags(self, n: int) -> np.ndarray:
        """Magnitudes of the contexts' counts; of single tokens, 1 for the start mark and 0 for the others."""
        if n == 1:
            return (np.arange(len(self.keys[1])) == self.start).astype(np.uint8)
        return magnitude(self.total[n - 1])[self.context[n]]

    def ask(self, fragments: int) -> pa.Table:
        n = len(self.of)
        order = np.argsort(self.keys[n], kind="stable")
        return rows(asked(self.id, n, self.keys[n][order], self.counts(n)[order], self.tags(n)[order], fragments), ASKS)

    def hear(self, answers: dict[int, np.ndarray], levels: int) -> None:
        """Take the answers level by level, growing in between."""
        for n in range(1, levels + 1):
            order = np.argsort(self.keys[n], kind="stable")
            self.total[n] = np.zeros(len(order), np.int64)
            if len(order):
                self.total[n][order] = (answers[n] >> np.uint64(1)).astype(np.int64)
            if n < ORDER:
                self.grow()

    def score(self, model: Model) -> pa.Table:
        """One run of the automaton over all texts of the block at once."""
        arc, fail = model.arcs(self)
        log = np.zeros(len(self.stream))
        todo = np.flatnonzero(self.stream != self.start)  # places of the tokens to score
        for n in range(ORDER, 0, -1):
            p = todo - n + 1
            inside = p >= np.repeat(self.at, self.sizes + 2)[todo]
            q, p = todo[inside], p[inside]
            if n > 1:  # only where the context is a state
                context = self.of[n - 1][p]
                state = self.reached(n - 1, context)
                q, p, context = q[state], p[state], context[state]
            gram = self.of[n][p]
            hit = self.seen(n, gram) if n > 1 else np.ones(len(p), bool)
            log[q[hit]] += arc[n][gram[hit]]
            if n > 1:
                log[q[~hit]] += fail[n - 1][context[~hit]]
            left = np.ones(len(self.stream), bool)
            left[q[hit]] = False
            todo = todo[left[todo]]
        seen = self.total[1][self.stream]
        base = np.log10((seen + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
        base[self.at] = 0
        known = (seen > 0).astype(np.int64)
        known[self.at] = 0
        every = [np.add.reduceat(x, self.at) for x in (known, base, log)]
        ids = pa.array(self.ids, mask=self.known == 0)
        n = len(self.ids)
        return pa.table([ids, pa.array(self.held == 1), pa.array(self.sizes.astype(np.int64) + 1), pa.array(every[0]), pa.array(np.full(n, model.tokens)), pa.array(every[1]), pa.array(every[2])], names=[x.split()[0] for x in RESULT.split(", ")])


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def magnitude(count: np.ndarray) -> np.ndarray:
    """Binary digits of the count."""
    return np.frexp(count.astype(float))[1].astype(np.uint8)


class Model:
    """Numbers that all blocks share: training tokens, distinct ones, and the weight of each order and magnitude."""

    def __init__(self, sums: dict[int, np.ndarray]):
        self.words, self.tokens, once = (int(x) for x in sums[1][:, 0])
        self.weight = {n: (s[1] - s[2]) / (s[1] + 1.0) for n, s in sums.items() if n > 1}
        self.known = (self.tokens - once) / (self.tokens + 1.0)

    def arcs(self, block: Block) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
        """log10 weights of the arcs of n-grams, and of the failure arcs of contexts."""
        share = block.total[1] / max(self.tokens, 1)
        p = {1: np.where(block.total[1] > 0, self.known * share, 1 - self.known)}
        fail = {}
        for n in range(2, len(block.of) + 1):
            count = block.total[n - 1]
            w = self.weight[n][magnitude(count)]
            fail[n - 1] = np.log10(1 - w)
            # what the shorter context says: the arc of the n-gram without its first token, or failures on the way to one
            at = block.first[n] + 1
            low = p[1][block.stream[at + n - 2]]
            for m in range(2, n):
                start = at + n - 1 - m
                gram, context = block.of[m][start], block.of[m - 1][start]
                state, seen = block.reached(m - 1, context), block.seen(m, gram)
                if not len(block.keys[m]):
                    continue
                low = np.where(seen, p[m][gram], np.where(state, (1 - self.weight[m][magnitude(block.total[m - 1][context])]) * low, low))
            c = np.maximum(count[block.context[n]], 1)
            w = w[block.context[n]]
            p[n] = w * block.total[n] / c + (1 - w) * low
        with np.errstate(divide="ignore"):
            return {n: np.log10(x) for n, x in p.items()}, fail


def scored(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    table = _blocks_of(docs)
    tokens = table.agg(F.sum("tokens")).first()[0] or 0
    answers: list[DataFrame] = []
    sums = {}
    for n in range(1, ORDER + 1):
        fragments = fragments_for(tokens if n > 1 else tokens // 4)

        def ask(block: pa.Table, there: dict[int, np.ndarray], fragments: int = fragments, known: int = n - 1) -> pa.Table:
            b = Block(block)
            b.hear(there, known)
            out = b.ask(fragments)
            release()
            return out

        answers.append(totals(each_block(table, answers, ask, ASKS), fragments, f"lm-{n}"))
        sums[n] = sums_of(answers[-1])
    model = spark.sparkContext.broadcast(Model(sums))  # a few kB

    def score(block: pa.Table, there: dict[int, np.ndarray]) -> pa.Table:
        b = Block(block)
        b.hear(there, ORDER)
        out = b.score(model.value)
        release()
        return out

    return each_block(table, answers, score, RESULT)
