"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Words are those of the text with A-Z in lower case and ASCII punctuation as spaces. Every item gives
windows of two sizes, about its own and about half of it (from a fixed ladder of sizes, so documents
need few window sizes), long items also of 255 words; each of them, at every offset in the item, is indexed by SimHash. Every window
of every ladder size in a document is looked up: the 64 bits are cut into four blocks, and windows
within three bits agree in at least one of them, so looking up each block finds all within the radius.
The half-sized windows make sure that a passage changed in one place still has a window unchanged.

Hits are lined up with their item and verified exactly on five-word shingles (the whole sequence of a
shorter item): the weighted Jaccard similarity of the item and the item-sized piece of the document must
be at least 0.75. A shingle weighs log(1 + items / items that hold it), counted over the whole benchmark.
Tasks know the weights of the items they look for; shingles that only the piece has are joined to the
counts afterwards, so a verdict doesn't depend on how the benchmark is cut into passes.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.tables import discard, map_arrow, written
from tidelake.llm.textkit import MOST_WORDS, MOST_WORDS_WIDE, PLAIN, U64, Words, as_long, bit_lanes, majority, shingles_of, slices
from tidelake.llm.textkit import wide_lanes, wide_majority

RADIUS = 3
SIMILAR = 0.75
#: Items are looked up in passes of about so many bytes; each pass goes over the documents once.
PASS_BYTES = 4 << 20

CANDIDATE = "item int, item_id long, word int, shared double, mine double, rest array<long>"


def ladder() -> list[int]:
    sizes = list(range(1, 9))
    for most in (MOST_WORDS, MOST_WORDS_WIDE):
        while sizes[-1] < most:
            sizes.append(min(most, math.ceil(sizes[-1] * 1.25)))
    return sizes


def item_sizes(n: int) -> set[int]:
    """Window sizes of an item of ``n`` words: the largest of the ladder up to n, up to half of it, and up to 255."""
    return {max(s for s in ladder() if s <= most) for most in (n, max(1, (n - 1) // 2), min(n, MOST_WORDS)) if most >= min(n, 4)}


class Running:
    """Sums of the words' lanes from the first word on; the wide ones are made when a long window asks."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.narrow, self.wide = hashes, None, None

    def __len__(self) -> int:
        return len(self.hashes)

    @staticmethod
    def summed(lanes: list[np.ndarray]) -> list[np.ndarray]:
        return [np.concatenate((np.zeros(1, dtype=U64), np.cumsum(lane, dtype=U64))) for lane in lanes]

    def fingerprints(self, size: int) -> np.ndarray:
        """SimHash of every window of ``size`` words."""
        if size <= MOST_WORDS:
            self.narrow = self.narrow or self.summed(bit_lanes(self.hashes))
            return majority([s[size:] - s[:-size] for s in self.narrow], size)
        self.wide = self.wide or self.summed(wide_lanes(self.hashes))
        return wide_majority([s[size:] - s[:-size] for s in self.wide], size)


class SizeIndex:
    """Windows of one size of all items, by each 16-bit block of their SimHash."""

    def __init__(self, prints: np.ndarray, items: np.ndarray, offsets: np.ndarray):
        self.prints, self.items, self.offsets = prints, items, offsets
        self.blocks = []
        for k in range(RADIUS + 1):
            values = self.block(prints, k)
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << 16) + 1)).astype(np.int32)
            self.blocks.append((starts[1:] > starts[:-1], starts, order))

    @staticmethod
    def block(prints: np.ndarray, k: int) -> np.ndarray:
        return (prints >> U64(16 * k)).astype(np.uint16)

    def within_radius(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, entry) of all pairs within the radius."""
        found = []
        for k, (used, starts, order) in enumerate(self.blocks):
            values = self.block(prints, k)
            hit = np.flatnonzero(used[values])
            first, many = starts[values[hit]], starts[values[hit].astype(np.int64) + 1] - starts[values[hit]]
            at = np.repeat(hit, many)
            step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            entry = order[np.repeat(first, many) + step]
            near = np.bitwise_count(prints[at] ^ self.prints[entry]) <= RADIUS
            found.append((at[near], entry[near]))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


class ItemIndex:
    """The items of one pass, by their windows; ``held_by`` counts the items of all passes by shingle."""

    def __init__(self, items: list[tuple[int, str]], held_by: dict[int, int], n_items: int):
        texts = pa.array([text for _, text in items], pa.string())
        self.ids = [item for item, _ in items]
        self.grams, self.sizes = [], []
        entries = defaultdict(list)
        for at, to, data, offsets in slices(texts):
            words = Words(PLAIN[data], offsets)
            hashes, bounds = words.hashes(), words.bounds
            for i in range(to - at):
                own = hashes[bounds[i] : bounds[i + 1]]
                self.grams.append(np.unique(shingles_of(own)))
                self.sizes.append(len(own))
                if not len(own):
                    continue
                sums = Running(own)
                for size in item_sizes(len(own)):
                    prints = sums.fingerprints(size)
                    entries[size].append((prints, np.full(len(prints), at + i), np.arange(len(prints))))
        self.by_size = {size: SizeIndex(*map(np.concatenate, zip(*found, strict=True))) for size, found in entries.items()}
        self.weights = [np.array([math.log(1 + n_items / held_by.get(g, 1)) for g in as_long(grams).tolist()]) for grams in self.grams]

    def candidate(self, item: int, piece: np.ndarray) -> tuple[float, float, np.ndarray] | None:
        """(weight shared, weight of the item, shingles only the piece has), if they may be similar enough.

        No shingle weighs less than log(2), so more of them than that allows can't be similar.
        """
        theirs = np.unique(shingles_of(piece))
        both = np.isin(self.grams[item], theirs, assume_unique=True)
        shared, mine = math.fsum(self.weights[item][both]), math.fsum(self.weights[item])
        rest = np.setdiff1d(theirs, self.grams[item], assume_unique=True)
        return (shared, mine, rest) if shared >= SIMILAR * (mine + len(rest) * math.log(2)) - 1e-9 else None

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple]:
        """(text, item, item_id, word, shared, mine, rest) of all places that may hold an item."""
        sums = Running(hashes)
        places = set()
        for size, index in self.by_size.items():
            if len(hashes) < size:
                continue
            at, entry = index.within_radius(sums.fingerprints(size))
            text = np.searchsorted(bounds, at, side="right") - 1
            inside = at + size <= bounds[text + 1]
            start = np.maximum(bounds[text], at - index.offsets[entry])
            places.update(zip(text[inside].tolist(), index.items[entry][inside].tolist(), start[inside].tolist(), strict=True))
        out = []
        for text, item, start in sorted(places):
            found = self.candidate(item, hashes[start : min(start + self.sizes[item], bounds[text + 1])])
            if found:
                out.append((text, item, self.ids[item], start - int(bounds[text]), found[0], found[1], as_long(found[2])))
        return out


def shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``gram``: the distinct shingles of each item."""
    for batch in batches:
        for at, to, data, offsets in slices(batch.column("text")):
            words = Words(PLAIN[data], offsets)
            hashes, bounds = words.hashes(), words.bounds
            for i in range(to - at):
                grams = np.unique(shingles_of(hashes[bounds[i] : bounds[i + 1]]))
                yield pa.RecordBatch.from_arrays([pa.array(as_long(grams))], names=["gram"])


def look_up(items: list[tuple[int, str]], held_by: dict[int, int], n_items: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(items, held_by, n_items)
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64())]
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                words = Words(PLAIN[data], offsets)
                found = index.candidates(words.hashes(), words.bounds)
                if found:
                    text, *columns = zip(*found, strict=True)
                    kept = batch.slice(at, to - at).select(names).take(pa.array(text, pa.int64()))
                    more = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*kept.columns, *more], names=[*names, *(c.split()[0] for c in CANDIDATE.split(", "))])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with item_id, similarity, word: one row per row and item found in its text.

    The best piece counts; ``word`` counts the words before it. Items without id or word, and texts that
    are NULL or empty, match nothing; repeated benchmark rows count once. The benchmark is taken in passes
    by hash of about ``PASS_BYTES``, each small enough to be sent to every task; an item is never cut.
    """
    spark = docs.sparkSession
    rows = docs.select(*keep, F.col("text").cast("string").alias("text")).withColumn("_row", F.monotonically_increasing_id())
    items = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna().distinct())
    n_items, n_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    held = written(map_arrow(items, shingle_rows, "gram long").groupBy("gram").agg(F.count("*").alias("held")))
    passes = max(1, -(-n_bytes // PASS_BYTES))
    in_pass = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    names = [*keep, "_row"]
    schema = T.StructType([*rows.select(*names).schema.fields, *spark.createDataFrame([], CANDIDATE).schema.fields])
    found = spark.createDataFrame([], schema).withColumns({"_pass": F.lit(0), "_place": F.lit(0).cast("long")})
    for k in range(passes):
        block = items.where(in_pass == k)
        texts = [tuple(r) for r in block.orderBy("item_id", "text").collect()]
        if not texts:
            continue
        grams = map_arrow(block, shingle_rows, "gram long").distinct()
        held_by = {r["gram"]: r["held"] for r in held.where("held > 1").join(grams, "gram").collect()}
        place = (F.monotonically_increasing_id() * passes + k).alias("_place")
        places = map_arrow(rows, look_up(texts, held_by, n_items, names), schema).select("*", F.lit(k).alias("_pass"), place)
        found = found.unionByName(written(places))
    best = written(best_pieces(found, held, n_items, keep))
    discard(items)
    return best


def best_pieces(found: DataFrame, held: DataFrame, n_items: int, keep: list[str]) -> DataFrame:
    """The most similar piece of each row and item among the places, weighing what only the piece has."""
    rest = found.select("_place", F.explode("rest").alias("gram")).join(held, "gram", "left")
    weighed = rest.select("_place", F.log(1 + n_items / F.coalesce("held", F.lit(1))).alias("weight"))
    # Added up in sorted order, so that the sum is the same in every run.
    total = F.aggregate(F.sort_array(F.collect_list("weight")), F.lit(0.0), lambda a, b: a + b)
    joined = found.join(weighed.groupBy("_place").agg(total.alias("_rest")), "_place", "left")
    similar = joined.withColumn("similarity", F.col("shared") / (F.col("mine") + F.coalesce("_rest", F.lit(0.0)))).where(F.col("similarity") >= SIMILAR)
    best = F.max(F.struct("similarity", (-F.col("word")).alias("back"))).alias("best")
    pieces = similar.groupBy("_row", "_pass", "item").agg(best, F.first("item_id").alias("item_id"), *(F.first(c).alias(c) for c in keep))
    return pieces.select(*keep, "item_id", "best.similarity", (-F.col("best.back")).alias("word"))


def leaked_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and item found in it: doc_id, item_id, similarity, word."""
    return leaks(docs, benchmark, ["doc_id"])


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with the columns of ``docs``."""
    digest = F.sha2(F.col("text").cast("string"), 256)
    leaky = written(leaks(docs.select(digest.alias("_digest"), "text"), benchmark, ["_digest"]).select("_digest").distinct())
    return docs.join(leaky, digest == F.col("_digest"), "left_anti").select(*docs.columns)
