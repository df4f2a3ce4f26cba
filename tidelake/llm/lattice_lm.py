"""Marginal likelihood of a text over all its segmentations into subwords.

The vocabulary is a given one; nothing is added to it. A text is its words, each after a word mark, and
one end. Pieces have a mark in front or none, so no piece reaches over a word's start, and the
probability of a text is the product of those of its words and of the end. A word's is the sum over all
ways to spell it in pieces, by a forward recursion in log space over its bytes. Single bytes are pieces
too, so every word has a spelling.

A unigram vocabulary brings log probabilities as its scores, which are used as they are. A vocabulary of
merges brings ranks: its pieces start with a weight that falls with the rank, and ``ROUNDS`` rounds of
expectation maximisation bring the weights to the training texts: every distinct training word spreads
its count over its spellings by forward and backward sums; the expected counts of the pieces, and
``PRIOR`` counts spread like the starting weights, are the next weights.

Words are counted over all texts, compared as text. Spellings are summed once for each distinct word. The
counts and sums of the ``COMMON_WORDS`` most frequent words of at most ``LONGEST_COMMON`` bytes are sent to
every task; rows of the other words are joined to the table of words, so no key of that join is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidelake.llm.tables import discard, map_arrow, written
from tidelake.llm.textkit import LOWER, Words, slices

MARK = "▁"
ROUNDS = 2
PRIOR = 1000.0
COMMON_WORDS = 65_536
LONGEST_COMMON = 32
#: Words are spelled in groups of about so many bytes.
GROUP_BYTES = 1 << 18
END = -1


class Pieces:
    """A trie over the byte strings of a vocabulary: ``walk`` finds every piece in a run of bytes."""

    def __init__(self, strings: list[bytes]):
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for piece, string in enumerate(strings):
            node = 0
            for byte in string:
                node = nodes.setdefault((node, byte), len(nodes) + 1)
            ends[node] = piece
        steps = np.array([(a << 8) | byte for a, byte in nodes], dtype=np.int64)
        order = np.argsort(steps)
        self.steps, self.to = steps[order], np.array(list(nodes.values()), dtype=np.int64)[order]
        self.piece = np.full(len(nodes) + 1, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())
        #: The first step of most walks is looked up directly.
        self.first = np.full(256, -1, dtype=np.int64)
        for byte in range(256):
            self.first[byte] = nodes.get((0, byte), -1)

    def walk(self, data: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces; ``last`` is the end of the word that each byte is in."""
        found = []
        at = np.arange(len(data))
        node, to = self.first[data], at + 1
        while len(at):
            there = node >= 0
            at, node, to = at[there], node[there], to[there]
            piece = self.piece[node]
            ends = piece >= 0
            found.append((at[ends], to[ends], piece[ends]))
            more = to < last[at]
            at, node, to = at[more], node[more], to[more]
            step = (node << 8) | data[to]
            place = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            node, to = np.where(self.steps[place] == step, self.to[place], -1), to + 1
        if not found:
            return at, at, at
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))


@dataclass
class Vocabulary:
    """``strings`` of all pieces, the log weight each starts with, and whether they are probabilities already."""

    strings: list[bytes]
    start: np.ndarray
    known: bool


def read_vocabulary(file: str) -> Vocabulary:
    """The pieces of a sentencepiece model; a merge vocabulary has whole numbers as scores, its ranks.

    Pieces with a mark inside or without a text of their own (controls) are left out. Bytes that are no
    piece by themselves are pieces of the rank after the last.
    """
    model = SentencePieceProcessor(model_file=file)
    found: dict[bytes, float] = {}
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        plain = not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k) or model.is_byte(k))
        if plain and piece and MARK not in piece[1:]:
            found.setdefault(piece.encode(), model.get_score(k))
    known = any(score != round(score) for score in found.values())
    least = min(found.values(), default=0.0)
    for byte in range(256):
        found.setdefault(bytes([byte]), least - 1)
    found.setdefault(MARK.encode(), least - 1)
    scores = np.array(list(found.values()))
    if not known:
        rank = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
        scores = -np.log(rank + 3.0)
    return Vocabulary(list(found), scores, known)


def sums_by(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the summed exponentials of ``values`` for every run of equal keys, and the keys."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.logaddexp.reduceat(values, first)


class Lattice:
    """All spellings of a group of words, given as one run of bytes with marks and the words' bounds."""

    def __init__(self, pieces: Pieces, data: np.ndarray, bounds: np.ndarray):
        self.bounds, size = bounds, np.diff(bounds)
        self.start, self.end, self.piece = pieces.walk(data, np.repeat(bounds[1:], size))
        #: A node for the place before every byte and for the end of every word: words don't share any.
        word = np.repeat(np.arange(len(size)), size)
        self.start, self.end = self.start + word[self.start], self.end + word[self.start]
        self.first, self.last = bounds[:-1] + np.arange(len(size)), bounds[1:] + np.arange(len(size))
        self.depth = np.arange(len(data) + len(size)) - np.repeat(self.first, size + 1)
        self.n = len(data) + len(size)

    def _recursion(self, here: np.ndarray, there: np.ndarray, seeds: np.ndarray, weight: np.ndarray, depth: np.ndarray) -> np.ndarray:
        out = np.full(self.n, -np.inf)
        out[seeds] = 0.0
        order = np.lexsort((here, depth[here]))
        level = depth[here][order]
        edges = np.flatnonzero(np.concatenate(([True], level[1:] != level[:-1], [True])))
        here, there, weight = here[order], there[order], weight[order]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            node, value = sums_by(here[a:b], out[there[a:b]] + weight[a:b])
            out[node] = value
        return out

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Log of the summed weights of all ways from a word's first node to each node."""
        return self._recursion(self.end, self.start, self.first, weights[self.piece], self.depth)

    def likelihoods(self, weights: np.ndarray) -> np.ndarray:
        return self.forward(weights)[self.last]

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of every piece in words that occur ``counts`` times."""
        size = np.diff(self.bounds) + 1
        total, before = np.repeat(counts, size), self.forward(weights)
        left = np.repeat(np.diff(self.bounds), size) - self.depth
        after = self._recursion(self.start, self.end, self.last, weights[self.piece], left)
        whole = np.repeat(before[self.last], size)
        share = np.exp(before[self.start] + weights[self.piece] + after[self.end] - whole[self.start])
        return np.bincount(self.piece, weights=share * total[self.start], minlength=len(weights))


def marked(words: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, bounds) of groups of words, each word after a mark."""
    mark = np.frombuffer(MARK.encode(), np.uint8)
    for at, to, data, offsets in slices(words, GROUP_BYTES):
        bounds = offsets + len(mark) * np.arange(len(offsets))
        out = np.empty(bounds[-1], dtype=np.uint8)
        places = np.arange(len(data)) + len(mark) * (np.repeat(np.arange(to - at), np.diff(offsets)) + 1)
        out[places] = data
        for k, byte in enumerate(mark):
            out[bounds[:-1] + k] = byte
        yield at, to, out, bounds


class Speller:
    """Made once for each task from the vocabulary that came with the function."""

    def __init__(self, strings: list[bytes], weights: np.ndarray):
        self.pieces, self.weights = Pieces(strings), weights

    def likelihoods(self, words: pa.Array) -> np.ndarray:
        parts = [Lattice(self.pieces, data, bounds).likelihoods(self.weights) for _, _, data, bounds in marked(words)]
        return np.concatenate(parts) if parts else np.zeros(0)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, pa.DictionaryArray]:
    """Words of a slice of texts with A-Z in lower case, as a dictionary of the different ones."""
    words = Words(data, offsets)
    size = words.ends - words.starts
    bounds = np.concatenate(([0], np.cumsum(size)))
    inside = np.repeat(words.starts - bounds[:-1], size) + np.arange(bounds[-1])
    strings = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(LOWER[data[inside]]))
    return words, strings.dictionary_encode()


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, learned, n) of (text, learned): counts of the different words of a slice, and of those in training texts."""
    for batch in batches:
        learns = batch.column("learned").to_numpy(zero_copy_only=False).astype(bool)
        for at, to, data, offsets in slices(batch.column("text"), 4 << 20):
            words, coded = words_of(data, offsets)
            codes, row = coded.indices.to_numpy(), np.repeat(np.arange(at, to), np.diff(words.bounds))
            n = np.bincount(codes, minlength=len(coded.dictionary))
            learned = np.bincount(codes[learns[row]], minlength=len(coded.dictionary))
            columns = [coded.dictionary.cast(pa.string()), pa.array(learned.astype(np.int64)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "learned", "n"])


def expected_counts(strings: list[bytes], weights: np.ndarray):
    """Expected counts of pieces over a task's words (word, learned)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = Pieces(strings), np.zeros(len(strings))
        for batch in batches:
            counts = batch.column("learned").to_numpy().astype(float)
            for at, to, data, bounds in marked(batch.column("word")):
                total += Lattice(pieces, data, bounds).expected(weights, counts[at:to])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["piece", "mass"])

    return run


def fitted(words: DataFrame, texts: int, vocabulary: Vocabulary) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and of the end, which is drawn like a piece, once a text."""
    weights = start = vocabulary.start - np.logaddexp.reduce(vocabulary.start)
    counts = words.where("learned > 0").select("word", "learned")
    drawn = 0.0
    for _ in range(1 if vocabulary.known else ROUNDS):
        got = map_arrow(counts, expected_counts(vocabulary.strings, weights), "piece long, mass double")
        # At most one row for each piece of the vocabulary comes to the driver.
        rows = got.groupBy("piece").agg(F.sum("mass").alias("mass")).toArrow()
        mass = PRIOR * np.exp(start)
        mass[rows.column("piece").to_numpy()] += rows.column("mass").to_numpy()
        drawn = float(mass.sum())
        if not vocabulary.known:
            weights = np.log(mass) - math.log(drawn)
    end = math.log(texts + 1) - math.log(texts + 1 + drawn)
    return weights + math.log(drawn) - math.log(texts + 1 + drawn), end


def spell(strings: list[bytes], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(strings, weights)
        for batch in batches:
            logs = pa.array(speller.likelihoods(batch.column("word")) / math.log(10))
            yield pa.RecordBatch.from_arrays([*batch.columns, logs], names=["word", "learned", "n", "log10"])

    return run


@dataclass
class Model:
    """The table of all words (word, learned, n, log10), and what every task gets of it."""

    words: DataFrame
    train_tokens: int
    kinds: int
    texts: int
    end_log10: float
    common: pa.Table

    def base(self, count):
        """log10 of the smoothed share of a token that was counted so often in training texts."""
        return np.log10((np.asarray(count, dtype=float) + 1) / (self.train_tokens + self.kinds + 1))


def learn(docs: DataFrame, learned: Column, vocabulary: Vocabulary) -> Model:
    """Word counts and the lattice model of the texts for which ``learned`` is true."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    n_texts = texts.where("learned").count()
    counted = map_arrow(texts, count_words, "word string, learned long, n long")
    words = written(counted.groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("n").alias("n")))
    weights, end = fitted(words, n_texts, vocabulary)
    table = written(map_arrow(words, spell(vocabulary.strings, weights), "word string, learned long, n long, log10 double"))
    discard(words)
    spoken, kinds = table.where("learned > 0").agg(F.sum("learned"), F.count("*")).first()
    # Broadcast with the function: COMMON_WORDS rows of at most LONGEST_COMMON bytes.
    short = table.where(F.octet_length("word") <= LONGEST_COMMON)
    common = short.orderBy(F.desc("n"), "word").limit(COMMON_WORDS).select("word", "learned", "log10").toArrow()
    return Model(table, (spoken or 0) + n_texts, kinds + (n_texts > 0), n_texts, end / math.log(10), common.combine_chunks())


def score_texts(model: Model, names: list[str]):
    """Rows with their counts and sums over common words; ``rare`` has the other words with their counts."""
    base, ends = model.base, [int(model.texts > 0), float(model.base(model.texts)), model.end_log10]
    common_words, common_learned = model.common.column("word"), model.common.column("learned").to_numpy()
    # A place more, of zeros, for words that are not among the common ones.
    known = np.append(common_learned > 0, False).astype(np.int64)
    base_of = np.append(base(common_learned), 0.0)
    model_of = np.append(model.common.column("log10").to_numpy(), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        values = common_words.combine_chunks()
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text"), 2 << 20):
                words, coded = words_of(data, offsets)
                n, codes = np.diff(words.bounds), coded.indices.to_numpy()
                row = np.repeat(np.arange(to - at), n)
                place = pc.index_in(coded.dictionary.cast(pa.string()), value_set=values).fill_null(len(values)).to_numpy()
                here = place[codes]
                total = [np.bincount(row, weights=x[here], minlength=to - at) for x in (known, base_of, model_of)]
                rare, often = np.unique((row * len(coded.dictionary) + codes)[here == len(values)], return_counts=True)
                owner, code = np.divmod(rare, max(len(coded.dictionary), 1))
                pairs = pa.StructArray.from_arrays([coded.dictionary.cast(pa.string()).take(pa.array(code)), pa.array(often)], names=["word", "times"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(to - at + 1)).astype(np.int32)), pairs)
                columns = [
                    pa.array((task << 33) + done + np.arange(at, to)), *(batch.column(c).slice(at, to - at) for c in names),
                    pa.array(n.astype(np.int64) + 1), pa.array(total[0].astype(np.int64) + ends[0]),
                    pa.array(total[1] + ends[1]), pa.array(total[2] + ends[2]), lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["_row", *names, "n_tokens", "n_known", "base_score", "score", "_rare"])
            done += len(batch)

    return run


OUTPUTS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score(docs: DataFrame, learned: Column, vocabulary: Vocabulary, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the rows for which ``learned`` is true (NULL: not); all rows are scored. Tokens are
    words (runs of anything but space and 0x09-0x0D, A-Z in lower case) and one end; a text that is NULL or
    has no word is its end alone. base_score sums log10((c + 1) / (N + V + 1)) over tokens, with c, N and V
    from the training tokens; score is log10 of the text's probability under the lattice model. Both are
    finite for every text, also without any training text. Rows that repeat each get their scores; columns of
    ``keep`` with the names of outputs give way.
    """
    keep = [c for c in keep if c not in OUTPUTS]
    model = learn(docs, learned, vocabulary)
    texts = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).select(*dict.fromkeys([*keep, "text"]))
    passed = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"_row long, {passed + ', ' if passed else ''}n_tokens long, n_known long, base_score double, score double, _rare array<struct<word string, times long>>"
    rows = written(map_arrow(texts, score_texts(model, keep), schema))
    rare = rows.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.times").join(model.words, "word")
    base = F.log10((F.col("learned") + 1) / F.lit(float(model.train_tokens + model.kinds + 1)))
    sums = rare.groupBy("_row").agg(
        F.sum(F.when(F.col("learned") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * base).alias("_base"),
        F.sum(F.col("times") * F.col("log10")).alias("_log10"),
    )
    whole = rows.drop("_rare").join(sums, "_row", "left")
    return whole.select(
        *keep,
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_log10", F.lit(0.0))).alias("score"),
    )
