"""The lattice model against enumeration of all spellings, and at the edges of its input."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelake.llm import lattice_lm
from tidelake.llm.queries import PIECES_FILE, op11_lattice_lm

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def spellings(data, pieces):
    if not data:
        yield ()
    for piece in pieces:
        if data.startswith(piece):
            for rest in spellings(data[len(piece) :], pieces):
                yield (piece, *rest)


def toy():
    strings = [b"\xe2\x96\x81a", b"ab", b"abc", b"ca", "é".encode(), *(bytes([b]) for b in range(256)), "▁".encode()]
    return lattice_lm.Vocabulary(strings, -np.log(np.arange(len(strings)) + 3.0), False)


def test_forward_sums_all_spellings_and_backward_spreads_counts():
    vocabulary = toy()
    weights = vocabulary.start - np.logaddexp.reduce(vocabulary.start)
    of = dict(zip(vocabulary.strings, weights, strict=True))
    words = ["abcab", "a", "éca", "zab", "cabca", ""]
    speller = lattice_lm.Speller(vocabulary.strings, weights)
    got = speller.likelihoods(pa.array(words))
    mass = collections.Counter()
    for k, word in enumerate(words):
        ways = [(way, math.exp(sum(of[p] for p in way))) for way in spellings(("▁" + word).encode(), vocabulary.strings)]
        whole = sum(p for _, p in ways)
        assert got[k] == pytest.approx(math.log(whole), rel=1e-12)
        for way, p in ways:
            for piece in way:
                mass[piece] += p / whole * (k + 1)
    (at, to, data, bounds), = lattice_lm.marked(pa.array(words))
    counts = np.arange(1, len(words) + 1, dtype=float)
    expected = lattice_lm.Lattice(speller.pieces, data, bounds).expected(weights, counts)
    assert expected == pytest.approx([mass[s] for s in vocabulary.strings], abs=1e-9)


def test_given_vocabulary_covers_every_word():
    vocabulary = lattice_lm.read_vocabulary(PIECES_FILE)
    assert not vocabulary.known and len(vocabulary.strings) > 30_000
    assert {bytes([b]) for b in range(256)} <= set(vocabulary.strings)
    assert not any("▁".encode() in s[1:] for s in vocabulary.strings)
    weights = vocabulary.start - np.logaddexp.reduce(vocabulary.start)
    logs = lattice_lm.Speller(vocabulary.strings, weights).likelihoods(pa.array(["the", "qqzzxx", "日本語", "x" * 50_000]))
    assert np.isfinite(logs).all() and logs[0] > logs[1] > logs[3]


def frame(spark, texts):
    rows = [(k, text, "x", 1.0) for k, text in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, base_score double").repartition(3)


def test_scores_against_a_plain_version(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcde", k=rng.randint(1, 6))) for _ in range(60)]
    texts = [(k, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for k in range(60)]
    texts += [(70, None), (71, ""), (72, " \n\t"), (73, "Only ONCE é日本"), (None, "abc abc"), (74, "a b"), (74, "a b"), (75, "z" * 3000)]
    monkeypatch.setattr(lattice_lm, "COMMON_WORDS", 20)  # most words take the way of the join
    docs = frame(spark, texts).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    vocabulary = toy()
    got = lattice_lm.score(docs, ~F.col("held_out"), vocabulary, ["doc_id", "held_out", "score", "text"]).collect()
    assert len(got) == len(texts)
    learns = [k is not None and zlib.crc32(str(k).encode()) % 7 != 2 for k, _ in texts]
    counts = collections.Counter(t for (_, text), yes in zip(texts, learns, strict=True) if yes for t in tokens(text))
    n, kinds, n_texts = sum(counts.values()), len(counts), sum(learns)
    weights = vocabulary.start - np.logaddexp.reduce(vocabulary.start)
    train = [w for w in counts if w is not None]
    for _ in range(lattice_lm.ROUNDS):
        mass = lattice_lm.PRIOR * np.exp(vocabulary.start - np.logaddexp.reduce(vocabulary.start))
        pieces = lattice_lm.Pieces(vocabulary.strings)
        for _, _, data, bounds in lattice_lm.marked(pa.array(train)):
            mass += lattice_lm.Lattice(pieces, data, bounds).expected(weights, np.array([counts[w] for w in train], dtype=float))
        weights = np.log(mass) - math.log(mass.sum())
    weights = weights + math.log(mass.sum() / (mass.sum() + n_texts + 1))
    end = math.log((n_texts + 1) / (mass.sum() + n_texts + 1))
    assert np.exp(weights).sum() + math.exp(end) == pytest.approx(1)
    speller = lattice_lm.Speller(vocabulary.strings, weights)
    every = sorted({t for _, text in texts for t in tokens(text) if t})
    log_of = dict(zip(every, speller.likelihoods(pa.array(every)), strict=True)) | {None: end}
    want = sorted(
        (str(k), text or "", len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)),
         round(sum(math.log10((counts[t] + 1) / (n + kinds + 1)) for t in tokens(text)), 8), round(sum(log_of[t] for t in tokens(text)) / math.log(10), 8))
        for k, text in texts
    )
    assert sorted((str(r.doc_id), r.text, r.n_tokens, r.n_known, round(r.base_score, 8), round(r.score, 8)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}


def test_no_rows_and_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    assert lattice_lm.score(docs.limit(0), F.lit(True), toy(), ["doc_id"]).count() == 0
    got = lattice_lm.score(docs, F.lit(False), toy(), ["doc_id"]).collect()
    assert all(r.train_tokens == 0 == r.n_known and math.isfinite(r.score) and r.base_score == 0.0 for r in got)


def test_query_gives_every_document_a_score(spark):
    got = op11_lattice_lm(spark, "/root/testdata/sf0.001").toPandas()
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert len(got) == documents.count()
    assert np.isfinite(got.score).all() and (got.score < 0).all() and (got.n_known <= got.n_tokens).all()
    assert got.held_out.sum() == sum(zlib.crc32(str(k).encode()) % 7 == 2 for k in got.doc_id)
