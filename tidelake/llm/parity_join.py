"""Exact Jaccard join of shingle sets by parity sketches.

A set's sketch is a row of blocks; every shingle's hash chooses a block and flips bits in it, so equal
shingles cancel and two sketches differ in at most as many blocks as the sets have differing shingles.
Sets of sizes a and b (a <= b) with a Jaccard similarity of 3/4 differ in at most (a + b) / 7 <= a / 3
shingles, hence in at most a / 3 blocks: of the non-empty blocks in a fixed order, the first a / 3 + 1
of both sets must have one in common (pigeonhole). Those blocks are the join keys. A set that has too
few non-empty blocks for the argument also sends its first single shingles, as a sketch with a block
for every hash. Blocks of shingles that very many texts hold stand last in the order, so a passage
shared by thousands of otherwise different texts seldom becomes a key; the order changes the work,
never the result.

The number of blocks goes with the size band of a set (powers of 16). A set near the upper end of its
band joins the next band as well, where its larger partners are.

Candidates that share a key are pruned by size and by parity sketches of 256, 2048 and at least 4096 bits, whose
Hamming distance is a lower bound of the differing shingles too; the rest are verified on their whole
shingle sets. Buckets of several groups are sought through by their smallest member (``meet``): large groups of
near copies share hundreds of buckets, and a pair that meets in many of them is compared once.
Shingles are compared by 64-bit hashes, sets by 64 bits while candidates are sought and 128 bits in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.linking import distinct_sets, linked_groups, shared_buckets
from tidelake.llm.tables import discard, map_arrow, written
from tidelake.llm.textkit import STEP, U64, Words, as_long, mix, shingles_of, slices

COMMON_SHINGLES = 200_000
COMMON_BITS = 23
SMALL_SIDE_ROWS = 500_000
BAND_BITS = 4
#: Bits of the large sketch, for sets of up to four shingles a bit, and as it grows.
SKETCH_BITS = 4096
SKETCH_STEP = 2
#: Sketch of a set in the table of sets, of 64 bits each; folded to four for the first comparison.
SKETCH_LONGS = 32
PARTS = [f"p{k}" for k in range(SKETCH_LONGS)]
#: Sets with more than half as many shingles as that has bits also bring one of at least two bits a shingle.
SETS = "doc_id long, version long, n_shingles long, set1 long, set2 long, " + ", ".join(f"{p} long" for p in PARTS) + ", wide array<long>"
#: Pairs whose sketches are compared at a time, and pairs or flags of pairs that are held at a time.
MEET_PAIRS = 1 << 14
MEET_HELD = 1 << 19
#: Rows that are looked through at a time, and members of a star in one cell; larger stars are dealt out.
MEET_ROWS = 100_000
CELL = 4096
MET = "a long, b long, a_component long, b_component long, gap long"
#: Sets that a task remembers as sent, so copies of one text send their keys once.
REMEMBERED = 200_000


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for at, to, data, offsets in slices(texts):
        words = Words(data, offsets)
        hashes, bounds = words.hashes(lower=True), words.bounds
        for row in range(to - at):
            yield at + row, np.unique(shingles_of(hashes[bounds[row] : bounds[row + 1]]))


def digest(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two longs."""
    pair = np.array([grams.sum(dtype=U64), np.bitwise_xor.reduce(mix(grams ^ STEP))], dtype=U64)
    return tuple(int(x) for x in as_long(mix(pair + U64(len(grams)))))


def dense_sketch(grams: np.ndarray, bits: int) -> np.ndarray:
    parity = np.bincount((grams & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8))


def wide_bits(n: int) -> int:
    """Bits of the wide sketch of a set of ``n`` shingles: a power of two that is at least 2 * n."""
    return 1 << max(1, 2 * n - 1).bit_length()


def describe_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.zeros((3 + SKETCH_LONGS, len(batch)), dtype=np.int64)
        wide, sizes = [np.zeros(0, dtype=np.int64)], np.zeros(len(batch) + 1, dtype=np.int32)
        for row, grams in shingle_sets(batch.column("text")):
            if len(grams):
                out[:3, row] = len(grams), *digest(grams)
                out[3:, row] = dense_sketch(grams, 64 * SKETCH_LONGS).view(np.int64)
            if (bits := wide_bits(len(grams))) > 64 * SKETCH_LONGS:
                wide.append(dense_sketch(grams, bits).view(np.int64))
                sizes[row + 1] = len(wide[-1])
        longer = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(np.concatenate(wide)), mask=pa.array(sizes[1:] == 0))
        names = ["doc_id", "version", "n_shingles", "set1", "set2", *PARTS, "wide"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("version"), *map(pa.array, out), longer], names=names)


def count_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles held by at least two different sets of a slice, with their counts there."""
    for batch in batches:
        for at, to, data, offsets in slices(batch.column("text"), 4 << 20):
            words = Words(data, offsets)
            hashes, bounds = words.hashes(lower=True), words.bounds
            sets = {}
            for i in range(to - at):
                grams = np.unique(shingles_of(hashes[bounds[i] : bounds[i + 1]]))
                if len(grams):
                    sets.setdefault(digest(grams), grams)
            grams, counts = np.unique(np.concatenate([np.zeros(0, U64), *sets.values()]), return_counts=True)
            often = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(as_long(grams[often])), pa.array(counts[often])], names=["gram", "n"])


def block_tokens(grams: np.ndarray, band: int, bits: int, need: int) -> tuple[list[np.ndarray], int]:
    """Keys of up to ``need`` non-empty blocks of the sorted ``grams``, in block order, and how many."""
    if not len(grams):
        return [], 0
    block = grams >> U64(64 - bits) if bits < 64 else grams
    starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    found = len(starts)
    if found > need:
        grams, starts = grams[: starts[need]], starts[:need]
    parity = np.bitwise_xor.reduceat(mix(grams), starts)
    return [mix(parity ^ mix(block[starts] * U64(512) + U64(band)))], min(found, need)


def set_tokens(grams: np.ndarray, is_common: np.ndarray) -> np.ndarray:
    """The join keys of one set."""
    n = len(grams)
    need = n // 3 + 1
    own = (n.bit_length() - 1) // BAND_BITS
    common = is_common[grams >> U64(64 - COMMON_BITS)]
    parts = (grams[~common], grams[common]) if common.any() else (grams, grams[:0])
    out: list[np.ndarray] = []

    def add(band: int, bits: int) -> int:
        keys, found = block_tokens(parts[0], 2 * band, bits, need)
        more, rest = block_tokens(parts[1], 2 * band + 1, bits, need - found) if found < need else ([], 0)
        out.extend(keys + more)
        return found + rest

    for band in {own, ((4 * n // 3).bit_length() - 1) // BAND_BITS}:
        if add(band, BAND_BITS * (band + 1)) < need:
            add(64 + band, 64)
    return np.concatenate(out)


def tokens_of(common: np.ndarray):
    is_common = np.zeros(1 << COMMON_BITS, dtype=bool)
    is_common[common.view(U64) >> U64(64 - COMMON_BITS)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            keys, owners, held = [], [], 0

            def packed() -> pa.RecordBatch:
                ids = np.repeat(np.array(owners, dtype=np.int64), [len(k) for k in keys])
                return pa.RecordBatch.from_arrays([pa.array(as_long(np.concatenate(keys))), pa.array(ids)], names=["bucket", "id"])

            for _, grams in shingle_sets(batch.column("text")):
                if len(grams) and (whole := digest(grams)) not in sent:
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(whole)
                    keys.append(set_tokens(grams, is_common))
                    owners.append(whole[0])
                    held += len(keys[-1])
                if held > 100_000:
                    yield packed()
                    keys, owners, held = [], [], 0
            if keys:
                yield packed()

    return run


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if it has few rows; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.count() <= SMALL_SIDE_ROWS else df


def with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (doc_id, text) which set the text has, its size and its large sketch."""
    for batch in batches:
        for at, to, data, offsets in slices(batch.column("text")):
            words = Words(data, offsets)
            hashes, bounds = words.hashes(lower=True), words.bounds
            sets = [np.unique(shingles_of(hashes[bounds[i] : bounds[i + 1]])) for i in range(to - at)]
            keys = pa.array([digest(grams)[0] for grams in sets], pa.int64())
            sizes = pa.array([len(grams) for grams in sets], pa.int64())
            sketches = pa.array([dense_sketch(grams, sketch_bits(len(grams))).tobytes() for grams in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, batch.column("text").slice(at, to - at), sizes, sketches], names=["id", "text", "n", "sketch"])


def sketch_bits(n: int) -> int:
    bits = SKETCH_BITS
    while n > bits // 4:
        bits *= SKETCH_STEP
    return bits


def bits_apart(left: np.ndarray, right: np.ndarray) -> int:
    """Hamming distance of two sketches of 64-bit values; the longer one is folded to the length of the other."""
    size = min(len(left), len(right))
    a, b = (x if len(x) == size else np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in (left, right))
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose large sketches differ in no more bits than linked sets can."""
    for batch in batches:
        sketches = zip(batch.column("a_sketch"), batch.column("b_sketch"), strict=True)
        apart = np.array([bits_apart(*(np.frombuffer(x.as_buffer(), U64) for x in pair)) for pair in sketches], dtype=np.int64)
        total = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(7 * apart <= total))


def verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = np.zeros(len(batch), dtype=bool)
        rights = shingle_sets(batch.column("b_text"))
        for (row, left), (_, right) in zip(shingle_sets(batch.column("a_text")), rights, strict=True):
            both = len(left) + len(right)
            union = len(np.unique(np.concatenate((left, right))))
            linked[row] = 100 * (both - union) >= 75 * union
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked))


def may_link(a: Column, b: Column) -> Column:
    total = a["n"] + b["n"]
    apart = sum((F.bit_count(a[s].bitwiseXOR(b[s])) for s in ("s0", "s1", "s2", "s3")), F.lit(0))
    return (4 * F.least(a["n"], b["n"]) >= 3 * F.greatest(a["n"], b["n"])) & (7 * apart <= total)


class Meeting:
    """Members of stars, each followed by its buckets, and the pairs of them that may be linked."""

    def __init__(self, rows: pa.Table):
        column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
        told = column["bucket"].is_null().to_numpy(zero_copy_only=False)
        self.id, self.n, self.component, self.side = (column[c].filter(pa.array(told)).to_numpy() for c in ("id", "n", "component", "side"))
        sketches = column["sketch"].drop_null()
        self.bits, self.length = sketches.flatten().to_numpy().view(U64), sketches.value_lengths().to_numpy()
        self.at = np.cumsum(self.length) - self.length
        self.sketch = self.bits[self.at[:, None] + np.arange(SKETCH_LONGS)] if len(self.id) else np.zeros((0, SKETCH_LONGS), U64)
        for k in np.flatnonzero(self.length > SKETCH_LONGS):
            self.sketch[k] = np.bitwise_xor.reduce(self.wide(k).reshape(-1, SKETCH_LONGS), axis=0)
        star, cell = (column[c].to_numpy() for c in ("star", "cell"))
        new = np.concatenate(([True], (star[1:] != star[:-1]) | (cell[1:] != cell[:-1])))
        group, member = (np.cumsum(x)[~told] - 1 for x in (new, told))
        bucket = column["bucket"].drop_null().to_numpy()
        order = np.lexsort((member, bucket, group))
        self.member, bucket, group = member[order], bucket[order], group[order]
        same = (bucket[1:] == bucket[:-1]) & (group[1:] == group[:-1])
        self.starts = np.flatnonzero(np.concatenate(([True], ~same))) if len(bucket) else np.zeros(0, np.int64)
        self.ends = np.append(self.starts[1:], len(bucket))
        self.group = group[self.starts]
        self.firsts = np.append(np.cumsum(told)[np.flatnonzero(new)] - 1, len(self.id))

    def wide(self, k: int) -> np.ndarray:
        return self.bits[self.at[k] : self.at[k] + self.length[k]]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of members that share a bucket, a before b. Of a dense star each pair comes once."""
        size = self.ends - self.starts
        some = size > 1
        self.starts, self.ends, self.group, size = self.starts[some], self.ends[some], self.group[some], size[some]
        flags = np.diff(self.firsts) ** 2
        meetings = np.bincount(self.group, size * (size - 1) // 2, len(flags))
        dense = (meetings > flags / 8) & (meetings > 2000)
        bounds = np.searchsorted(self.group, np.arange(len(flags) + 1))
        for star in np.flatnonzero(dense):
            yield from self.flagged(*self.firsts[star : star + 2], range(*bounds[star : star + 2]))
        rest = np.flatnonzero(~dense[self.group])
        sizes = np.repeat(size[rest], size[rest])
        rows = np.repeat(self.starts[rest] - (np.cumsum(size[rest]) - size[rest]), size[rest]) + np.arange(len(sizes))
        after = np.repeat(self.ends[rest], size[rest]) - rows - 1
        total, at = np.cumsum(after), 0
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(total, total[at] - after[at] + MEET_HELD, side="right")))
            counts = after[at:to]
            a = np.repeat(rows[at:to], counts)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
            a, b = self.member[a], self.member[b]
            keep = self.component[a] != self.component[b]
            both = np.unique(a[keep] * len(self.id) + b[keep])
            yield both // len(self.id), both % len(self.id)
            at = to

    def flagged(self, first: int, last: int, buckets: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the members ``first`` to ``last``, by a flag for each, some rows of flags at a time."""
        met = [self.member[self.starts[k] : self.ends[k]] - first for k in buckets]
        step = max(1, MEET_HELD // (last - first))
        for at in range(0, last - first, step):
            flags = np.zeros((min(step, last - first - at), last - first), dtype=bool)
            for members in met:
                here = members[np.searchsorted(members, at) : np.searchsorted(members, at + len(flags))]
                flags[(here - at)[:, None], members] = True
            flags &= np.arange(at, at + len(flags))[:, None] < np.arange(last - first)
            flags &= self.component[first + at : first + at + len(flags), None] != self.component[first:last]
            a, b = np.nonzero(flags)
            yield a + first + at, b + first

    def close(self) -> Iterator[pa.RecordBatch]:
        """The pairs of different components whose sketches leave room for a link."""
        for every_a, every_b in self.pairs():
            n = self.n[every_a], self.n[every_b]
            keep = (4 * np.minimum(*n) >= 3 * np.maximum(*n)) & (self.side[every_a] == -self.side[every_b])
            every_a, every_b = every_a[keep], every_b[keep]
            for at in range(0, len(every_a), MEET_PAIRS):
                a, b = every_a[at : at + MEET_PAIRS], every_b[at : at + MEET_PAIRS]
                apart = 7 * np.bitwise_count(self.sketch[a] ^ self.sketch[b]).sum(axis=1, dtype=np.int64)
                room = apart <= self.n[a] + self.n[b]
                a, b, apart = a[room], b[room], apart[room]
                for k in np.flatnonzero(np.minimum(self.length[a], self.length[b]) > SKETCH_LONGS):
                    apart[k] = 7 * bits_apart(self.wide(a[k]), self.wide(b[k]))
                total = self.n[a] + self.n[b]
                room = apart <= total
                a, b, gap = a[room], b[room], 1000 * apart[room] // total[room]
                found = (self.id[a], self.id[b], self.component[a], self.component[b], gap)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b", "a_component", "b_component", "gap"])


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``MET`` of rows by star, cell and id, a member's sketch before its buckets."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < MEET_ROWS:
            continue
        star, cell = (batch.column(c).to_numpy() for c in ("star", "cell"))
        new = np.flatnonzero((star[1:] != star[:-1]) | (cell[1:] != cell[:-1]))
        if len(new):
            held[-1] = batch.slice(0, int(new[-1]) + 1)
            yield from Meeting(pa.Table.from_batches(held)).close()
            held = [batch.slice(int(new[-1]) + 1)]
    if sum(map(len, held)):
        yield from Meeting(pa.Table.from_batches(held)).close()


def met_by_star(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """``MET`` of (bucket, star, id, component), as a written table; ``sets`` has (id, n, sketch).

    All buckets of a star go to one task, so that members are sent once and pairs are compared once. A star with
    more than ``CELL`` members is dealt out in cells: one for every two pieces of it.
    """
    members = written(mixed.groupBy("star", "id").agg(F.min("component").alias("component")))
    wide = members.groupBy("star").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("pieces")).where("pieces > 1")
    none = F.lit(None)
    told = members.join(sets, "id").select("star", none.cast("long").alias("bucket"), "id", "n", "component", "sketch")
    buckets = mixed.select("star", "bucket", "id", none.cast("long").alias("n"), none.cast("long").alias("component"), none.cast("array<long>").alias("sketch"))
    dealt = told.union(buckets).join(wide, "star", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("id"), "pieces")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    dealt = dealt.withColumn("cell", F.least("piece", "other") * F.col("pieces") + F.greatest("piece", "other"))
    dealt = dealt.withColumn("side", F.signum(F.col("piece") - F.col("other")).cast("long")).drop("pieces", "piece", "other")
    rows = dealt.repartition("star", "cell").sortWithinPartitions("star", "cell", "id", F.col("bucket").asc_nulls_first())
    pairs = written(map_arrow(rows, meet, MET).dropDuplicates(["a", "b"]))
    discard(members)
    return pairs


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id. See ``grouped``."""
    return grouped(docs).drop("version")


def grouped(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, version (xxhash64 of the text, as text), n_shingles, component_id.

    Words are runs of anything but space and 0x09-0x0D, with A-Z in lower case; a set holds the distinct
    five-word shingles, or the whole sequence of a shorter text. Rows with equal sets are linked, and
    rows whose sets have a Jaccard similarity of at least 0.75; ``component_id`` is the smallest doc_id
    reachable. A text that is NULL or has no word has n_shingles 0 and stands alone. A row without
    doc_id can be no one's partner: its component_id is that of its exact copies, or NULL. Rows that
    repeat a doc_id each go by their own text. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = written(map_arrow(texts.withColumn("version", F.xxhash64("text")), describe_sets, SETS))
    classes = written(
        sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set1", "set2")
        .agg(F.min("doc_id").alias("id"), *(F.first(c).alias(c) for c in ("n_shingles", *PARTS, "wide")))
    )
    named = texts.where("doc_id IS NOT NULL")
    common = (
        map_arrow(named.select("text"), count_common, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "gram").limit(COMMON_SHINGLES).select("gram").toArrow().column("gram").to_numpy()
    )
    tokens = map_arrow(named.select("text"), tokens_of(common), "bucket long, id long")
    every = written(shared_buckets(tokens))
    shared = distinct_sets(every)
    discard(every)
    folded = (reduce(Column.bitwiseXOR, (F.col(f"p{k + 4 * j}") for j in range(SKETCH_LONGS // 4))).alias(f"s{k}") for k in range(4))
    info = F.struct(F.col("n_shingles").alias("n"), *folded)

    sketches = classes.select(F.col("set1").alias("id"), F.col("n_shingles").alias("n"), F.coalesce("wide", F.array(*PARTS)).alias("sketch"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs)
        needed = pairs.select(F.col("a").alias("set1")).union(pairs.select("b")).distinct()
        needed = written(classes.join(needed, "set1", "left_semi").select(F.col("id").alias("_id")))
        found = named.join(small_side(needed), named.doc_id == F.col("_id"), "left_semi")
        # Of a doc_id that repeats with several texts all come along; pairs find theirs by its digest.
        bodies = written(map_arrow(found, with_sketch, "id long, text string, n long, sketch binary").dropDuplicates(["id"]))

        def sided(df: DataFrame, *columns: str) -> DataFrame:
            left = bodies.select(F.col("id").alias("a"), *(F.col(c).alias(f"a_{c}") for c in columns))
            right = bodies.select(F.col("id").alias("b"), *(F.col(c).alias(f"b_{c}") for c in columns))
            return df.join(left, "a").join(right, "b")

        close = written(map_arrow(sided(pairs, "n", "sketch"), within_bound, "a long, b long"))
        linked = written(map_arrow(sided(close, "text"), verify_pairs, "a long, b long"))
        discard(pairs, needed, bodies, close)
        return linked

    groups = linked_groups(shared, classes.select(F.col("set1").alias("id"), info.alias("info")), may_link, verify, lambda mixed: met_by_star(mixed, sketches))
    discard(shared)
    # A group's component is its smallest doc_id, not its smallest digest.
    member = classes.select("set1", "set2", "id").join(groups.toDF("set1", "group"), "set1", "left")
    least = member.where("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("least"))
    member = member.join(least, "group", "left").select("set1", "set2", F.coalesce("least", "id").alias("component_id"))
    alone = F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")))
    return sets.join(member, ["set1", "set2"], "left").select("doc_id", "version", "n_shingles", alone.alias("component_id"))
