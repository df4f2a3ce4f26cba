"""Quality by nearest-neighbour voting on latent-semantic vectors.

A text is a vector of hashed counts: triples of character classes (letters by case, digits, white space,
each ASCII mark of its own), words with A-Z in lower case, and words that repeat their neighbour. Counts
are damped and weighted by inverse document frequency over all documents, each of the two parts is
brought to length one, and the result is projected on the leading singular vectors of a labelled sample.

The sample is bounded: ``SAMPLE`` labelled texts, lowest hash of the id first. Its vectors and labels are
sent to every task (about 300 bytes each); every document is compared with all of them, in blocks, and
its score is the mean label of the ``NEIGHBOURS`` nearest (ties: smaller ids), weighted by a power of their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.tables import map_arrow, written
from tidelake.llm.textkit import U64, Words, mix, slices

SAMPLE = 4000
CLASS_DIMS = 1024
WORD_DIMS = 1024
DIMS = CLASS_DIMS + WORD_DIMS
RANK = 64
NEIGHBOURS = 15
POWER = 8
CUTOFF = 0.3
WORD_PART = 0.5

_codes = np.arange(256)
#: Character classes: 0 other bytes, 1 lower case, 2 upper case, 3 digits, 4 blanks, 5 newline, then marks.
CLASSES = np.zeros(256, dtype=np.int64)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58] = 1, 2, 3
CLASSES[[9, 11, 12, 13, 32]], CLASSES[10] = 4, 5
_marks = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASSES[_marks] = 6 + np.arange(len(_marks))
REPEAT = CLASS_DIMS - 1


def bucket(values: np.ndarray, dims: int) -> np.ndarray:
    return (mix(values.astype(U64)) % U64(dims)).astype(np.int64)


TRIPLES = bucket(np.arange(48**3), CLASS_DIMS - 1)


def counts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts of a slice of texts, one row each."""
    n = len(offsets) - 1
    out = np.zeros(n * DIMS)
    size = np.diff(offsets)
    if len(data) > 2:
        classes = CLASSES[data]
        triples = TRIPLES[(classes[:-2] * 48 + classes[1:-1]) * 48 + classes[2:]]
        row = np.repeat(np.arange(n), size)
        inside = row[:-2] == row[2:]
        out += np.bincount((row[:-2] * DIMS + triples)[inside], minlength=n * DIMS)
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    row = np.repeat(np.arange(n), np.diff(words.bounds))
    out += np.bincount(row * DIMS + CLASS_DIMS + (hashes % U64(WORD_DIMS)).astype(np.int64), minlength=n * DIMS)
    again = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    out += np.bincount(row[1:][again] * DIMS + REPEAT, minlength=n * DIMS)
    return out.reshape(n, DIMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts times ``idf``, both parts of length one."""
    x = (np.log1p(counts) * idf).astype(np.float32)
    for part, most in ((x[:, :CLASS_DIMS], 1.0), (x[:, CLASS_DIMS:], WORD_PART)):
        length = np.linalg.norm(part, axis=1, keepdims=True)
        part *= most / np.where(length > 0, length, 1)
    return x


def to_unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 1e-9, length, 1)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Of every dimension, the number of texts that have it; and of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                held += (counts_of(data, offsets) > 0).sum(axis=0)
                n += to - at
        dims = pa.array(np.append(np.arange(DIMS), -1), pa.int32())
        yield pa.RecordBatch.from_arrays([dims, pa.array(np.append(held, n))], names=["dim", "n"])

    rows = map_arrow(docs.select("text"), run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    found = dict(map(tuple, rows))
    return np.array([found.get(d, 0) for d in range(DIMS)]), found.get(-1, 0)


def labelled_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Labels and counts of the sampled rows (doc_id, text, label), in the order of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                packed = [row.astype(np.float32).tobytes() for row in counts_of(data, offsets)]
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(packed, pa.binary())], names=["doc_id", "label", "counts"])

    got = map_arrow(sample, run, "doc_id long, label int, counts binary").orderBy("doc_id", "label", "counts").toArrow()
    counts = np.frombuffer(b"".join(got.column("counts").to_pylist()), np.float32).reshape(-1, DIMS)
    return got.column("label").to_numpy(), counts


def principal(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors, by a randomised range finder with power iterations."""
    rng = np.random.default_rng(7)
    rank = min(rank, *x.shape)
    basis = x.T @ rng.standard_normal((len(x), min(rank + 16, len(x))), dtype=np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(basis)
        basis = x.T @ (x @ basis)
    basis, _ = np.linalg.qr(basis)
    _, _, turned = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ turned.T[:, :rank]).astype(np.float32)


def first_of_most(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values of every row; of equal ones the first count."""
    least = -np.partition(-values, k - 1, axis=1)[:, k - 1 : k]
    above, level = values > least, values == least
    chosen = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(chosen)[1].reshape(-1, k)


class Voter:
    def __init__(self, idf: np.ndarray, axes: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.idf, self.axes, self.vectors, self.labels = idf, axes, vectors, labels.astype(np.float64)
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.labels):
            return out
        vectors = to_unit(weighted(counts, self.idf) @ self.axes)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(vectors), 256):
            cosines = vectors[at : at + 256] @ self.vectors.T
            nearest = first_of_most(cosines, k)
            weight = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** POWER
            total = weight.sum(axis=1)
            votes = (weight * self.labels[nearest]).sum(axis=1)
            np.divide(votes, total, out=out[at : at + 256], where=total > 1e-12)
        return np.clip(out, 0.0, 1.0)


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of at most ``SAMPLE`` labelled texts, lowest hash of the id first.

    They are chosen on ids and hashes of texts; only the chosen texts leave the scan.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").dropna()
    rows = named.select("doc_id", F.xxhash64("text").alias("version")).distinct()
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).dropna().distinct()
    chosen = written(rows.join(told, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "version").limit(SAMPLE))
    # Broadcast: SAMPLE rows of 20 bytes.
    texts = named.withColumn("version", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "version"])
    return texts.groupBy("doc_id", "version", "label").agg(F.min("text").alias("text")).drop("version")


def fit(docs: DataFrame, learned: DataFrame, labels: DataFrame) -> Voter:
    """From all ``docs`` the document frequencies; from those in ``learned`` with a label the neighbours."""
    held, n = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + held)) + 1
    labels, counts = labelled_counts(sampled(learned, labels))
    if not len(labels):
        return Voter(idf, np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    x = weighted(counts, idf)
    axes = principal(x, RANK)
    return Voter(idf, axes, to_unit(x @ axes), labels)


def classify(docs: DataFrame, learned: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.3).

    Neighbours are texts of ``learned`` (doc_id, text) with a row in ``labels`` (doc_id, label); rows without
    id, text or label teach nothing, rows that repeat are one. Of equally near neighbours the smaller ids
    vote. Empty and NULL texts, and all texts if there are no labels, get the share of label 1 in the
    sample (0.5 without one). Columns of ``keep`` with the names of outputs give way.
    """
    docs = docs.withColumn("text", F.col("text").cast("string"))
    voter = fit(docs, learned.withColumn("text", F.col("text").cast("string")), labels)
    keep = [c for c in keep if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [voter.scores(counts_of(data, offsets)) for _, _, data, offsets in slices(batch.column("text"))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            columns = [*(batch.column(c) for c in keep), pa.array(scores), pa.array((scores >= CUTOFF).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    more = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    read = list(dict.fromkeys([*keep, "text"]))
    return map_arrow(docs.select(*read), run, T.StructType([*(docs.schema[c] for c in keep), *more]))
