"""Benchmark items planted in documents, found end to end, however the benchmark is cut."""

import collections
import math
import random

import numpy as np

from tidelake.llm import decontamination, textkit

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8))) for _ in range(n)]


def grams(tokens):
    return {tuple(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))}


def similarity(item, piece, held, n_items):
    def weight(found):
        return math.fsum(math.log(1 + n_items / held.get(g, 1)) for g in found)

    return weight(grams(item) & grams(piece)) / weight(grams(item) | grams(piece))


def planted(seed):
    rng = random.Random(seed)
    shared = words(rng, 12)
    items = {k: words(rng, n) for k, n in enumerate([6, 9, 14, 20, 33, 45, 60, 90, 130, 200, 254, 300, 420, 700, 1100])}
    for k in (3, 5, 7, 9, 11, 13):
        items[k][2:14] = shared  # an opening that many items have in common
    texts, truth = [], {}
    held = collections.Counter(g for item in items.values() for g in grams(item))
    for k, item in items.items():
        for copy in range(6):
            piece = list(item)
            for _ in range(min(8, copy * len(item) // 60)):
                piece[rng.randrange(len(piece))] = rng.choice(["other", *shared])
            if copy == 5 and len(item) > 40:
                piece[20:32] = shared  # what the piece has beyond the item is common in the benchmark
            doc = 100 * k + copy
            texts.append((doc, " ".join(words(rng, 40) + piece + words(rng, 25))))
            truth[doc, k] = similarity(item, piece, held, len(items))
    texts += [(10_000 + k, " ".join(words(rng, 500))) for k in range(20)] + [(20_000, None), (20_001, "")]
    return texts, [(k, " ".join(item)) for k, item in items.items()], truth


def test_planted_passages_are_found_and_passes_change_nothing(spark, monkeypatch):
    texts, items, truth = planted(6)
    docs, benchmark = spark.createDataFrame(texts, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): (r.similarity, r.word) for r in decontamination.leaked_items(docs, benchmark).collect()}
    similar = {key for key, value in truth.items() if value >= 0.75}
    assert len(similar) >= 60 and similar <= set(got)
    for key, (value, word) in got.items():
        assert value >= 0.75 and value >= truth.get(key, 0) - 1e-9
        if word == 40:
            assert abs(value - truth[key]) < 1e-9
    monkeypatch.setattr(decontamination, "PASS_BYTES", 2500)
    again = {(r.doc_id, r.item_id): (r.similarity, r.word) for r in decontamination.leaked_items(docs, benchmark).collect()}
    assert again.keys() == got.keys() and all(abs(again[k][0] - got[k][0]) < 1e-12 and again[k][1] == got[k][1] for k in got)
    kept = {r.doc_id for r in decontamination.without_leaks(docs, benchmark).collect()}
    assert kept == {k for k, _ in texts} - {doc for doc, _ in got}


def test_windows_of_any_length_hash_by_majority():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 64, size=3000, dtype=np.uint64)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    for size in (256, 700, 2999):
        got = decontamination.Running(hashes).fingerprints(size)
        want = bits[5 : 5 + size].sum(axis=0) > size // 2 if size < 2990 else bits[:size].sum(axis=0) > size // 2
        at = 5 if size < 2990 else 0
        assert np.bitwise_count(got[at]) == want.sum()
    top = textkit.wide_majority([np.full(1, 0xFFFF, np.uint64)] * 16, 65_535)
    assert np.bitwise_count(top[0]) == 16
    assert max(decontamination.item_sizes(1100)) > 900 and 255 in decontamination.item_sizes(1100)
