"""Fuzzy line dedup: SimHash blocks of normalised lines, edit similarity, one occurrence of each group.

A line is normalised byte by byte (A-Z to lower case, ASCII punctuation to spaces, digits to 0) and is
the sequence of its words. Lines with equal sequences are one line (by 128 bits). Two others are linked if
their word sequences have an edit similarity (1 - edits / words of the longer) of at least 0.9.

Candidates come from two sources. The first are ``SIMHASHES`` independent SimHashes of 64 bits over all words:
each is cut into four blocks, and a block with the line's length band is a key; two prints that differ in at
most three bits share a block (pigeonhole), and more distant ones often do. No radius is applied afterwards:
the edits decide. On the test documents this source alone meets 98 % of the pairs. The second source makes
sure of the rest. An edit changes only triples (runs of ``GRAM`` words) around one word, so triples that don't
overlap need an edit each. A line of n words may differ from a similar one in n / 9 edits; it sends its first
triples, in an order that holds for all lines, up to the one that makes n / 9 + 1 of them free of overlaps. If
two lines sent no triple in common, the one whose last triple comes first would have lost all it sent, by
more edits than similar lines differ in. Triples that many lines hold come last in the order, so a passage in
many otherwise different lines is seldom a key; the order changes the work, never the result. All
pairs of up to ``SMALL`` lines that share a triple are candidates; larger sets go by ``linking.linked_groups``.
Candidates are pruned by length and by parity sketches of their words, whose distance is at most twice the edits,
where keys meet; the closest pair of each line is verified first, then those of different groups. Lines of fewer than nine words can only be similar to equal ones and send no keys.

Of every connected group the first occurrence stays, by doc_id, then position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.linking import components, distinct_sets, linked_groups, shared_buckets, with_component
from tidelake.llm.tables import discard, map_arrow, release_shuffles, written
from tidelake.llm.textkit import MOST_WORDS, PLAIN, STEP, U64, Words, as_long, bit_lanes, majority, mix, slices, windows

SIMHASHES = 3
BLOCKS = 4
#: Length bands grow by this factor; a line joins the next one too if its longer partners may be there.
BAND = 1.5
#: Lines that a task remembers as sent, so repeated lines send their keys once.
REMEMBERED = 500_000
SIMILAR = 0.9
FEWEST_WORDS = 9
GRAM = 3
COMMON_GRAMS = 20_000
SKETCH_LONGS = 16
#: Sketch that goes with a key: one long, and as many as this for lines of more than ``SHORT`` words.
KEY_LONGS = 4
SHORT = 128
#: Keys have so many bits, the lowest of which tells triples from SimHash blocks; the line's words come above them.
KEY_BITS = 40
KEY_WORDS = (1 << 63 - KEY_BITS) - 1
SMALL = 32
NEXT = 16
#: Rows that a task takes at once where keys meet.
MEET_ROWS = 1 << 16
SMALL_SIDE_ROWS = 500_000

_digits = np.arange(256)
FOLDED = np.where((_digits >= 0x30) & (_digits <= 0x39), 0x30, PLAIN).astype(np.uint8)
FOLDED[0x0A] = 0x0A


class Lines:
    """Normalised lines of a slice of texts: text, number in it, and words of each.

    The empty last line of a text that ends in a newline is left out; it has no words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = FOLDED[data]
        cuts = np.flatnonzero(self.data == 0x0A) + 1
        texts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins = np.unique(np.concatenate((texts, cuts[cuts < len(data)])))
        self.edges = np.append(begins, len(data)) if len(begins) else np.zeros(1, dtype=np.int64)
        self.text = np.searchsorted(offsets, begins, side="right") - 1
        self.number = np.arange(len(begins)) - np.searchsorted(self.text, self.text)
        words = Words(self.data, self.edges)
        self.hashes, self.bounds = words.hashes(), words.bounds
        self.n = np.diff(self.bounds)
        self.with_words = np.flatnonzero(self.n)

    def keys(self) -> np.ndarray:
        """A hash of the word sequence of every line with words."""
        if not len(self.hashes):
            return self.hashes
        at = np.arange(len(self.hashes)) - np.repeat(self.bounds[:-1], self.n)
        parts = mix(self.hashes ^ mix(at.astype(U64)))
        return mix(np.add.reduceat(parts, self.bounds[:-1][self.with_words]))

    def checks(self) -> np.ndarray:
        """A second hash of every word sequence, independent of ``keys``."""
        if not len(self.hashes):
            return self.hashes
        at = np.arange(len(self.hashes)) - np.repeat(self.bounds[:-1], self.n)
        parts = mix(mix(self.hashes + mix(at.astype(U64) ^ STEP)))
        return mix(np.bitwise_xor.reduceat(parts, self.bounds[:-1][self.with_words]) ^ self.n[self.with_words].astype(U64))

    def flips(self) -> list[np.ndarray]:
        """A parity sketch of every line with words, of ``KEY_LONGS`` longs: every word flips one bit.

        Short lines have it folded into the first long.
        """
        if not len(self.hashes):
            return [self.hashes] * KEY_LONGS
        starts, bits = self.bounds[:-1][self.with_words], U64(1) << (self.hashes & U64(63))
        part = (self.hashes >> U64(6)) % U64(KEY_LONGS)
        flips = [np.bitwise_xor.reduceat(np.where(part == U64(k), bits, U64(0)), starts) for k in range(KEY_LONGS)]
        short = self.n[self.with_words] <= SHORT
        folded = [np.where(short, np.bitwise_xor.reduce(flips), flips[0])]
        return folded + [np.where(short, U64(0), x) for x in flips[1:]]

    def simhashes(self, variant: int = 0) -> np.ndarray:
        """The SimHash over all words of every line with words; variants hash the words anew."""
        if not len(self.hashes):
            return self.hashes
        hashes, n = mix(self.hashes ^ U64(variant)) if variant else self.hashes, self.n[self.with_words]
        starts = self.bounds[:-1][self.with_words]
        out = majority([np.add.reduceat(lane, starts) for lane in bit_lanes(hashes)], np.minimum(n, MOST_WORDS))
        for i in np.flatnonzero(n > MOST_WORDS):
            sums = np.zeros((8, 8), dtype=np.int64)
            for at in range(starts[i], starts[i] + n[i], 1 << 14):
                part = hashes[at : min(at + (1 << 14), starts[i] + n[i])]
                sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8, 1), axis=2, bitorder="little").sum(axis=0, dtype=np.int64)
            most = (sums > n[i] // 2).T[:, ::-1]  # the order in which majority() places them
            out[i] = np.packbits(most.reshape(-1), bitorder="little").view(U64)[0]
        return out


    def senders(self) -> np.ndarray:
        """The lines that send keys, equal ones once."""
        _, firsts = np.unique(self.keys(), return_index=True)
        lines = self.with_words[np.sort(firsts)]
        return lines[self.n[lines] >= FEWEST_WORDS]

    def grams(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and number of the line (within ``lines``) of all runs of ``GRAM`` words."""
        n = self.n[lines] - GRAM + 1
        owner = np.repeat(np.arange(len(lines)), n)
        place = np.arange(len(owner)) + np.repeat(self.bounds[:-1][lines] - np.cumsum(n) + n, n)
        return windows(self.hashes, GRAM)[place], place, owner


def blocks_of(lines: Lines, senders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """SimHash block keys of lines, and the number of the line (within ``senders``) of each."""
    n, at = lines.n[senders], np.searchsorted(lines.with_words, senders)
    own = bands(n)
    keys, owners = [], []
    prints_of = [lines.simhashes(variant)[at] for variant in range(SIMHASHES)]
    for band, rows in ((own, np.arange(len(n))), (own + 1, np.flatnonzero(bands(longest_partner(n)) > own))):
        for variant in range(SIMHASHES):
            prints = prints_of[variant][rows]
            for block in range(BLOCKS):
                part = (prints >> U64(16 * block)) & U64(0xFFFF)
                keys.append(mix(part | U64(block << 16 | variant << 20) | (band[rows].astype(U64) << U64(32)) | U64(1 << 63)))
                owners.append(rows)
    return np.concatenate(keys), np.concatenate(owners)


def bands(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(BAND) + 1e-9).astype(np.int64)


def longest_partner(n: np.ndarray) -> np.ndarray:
    return np.floor(n / SIMILAR + 1e-9)


LINES = "doc_id long, version long, line_no int, line long, check long"


def describe_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, offsets in slices(batch.column("text")):
            lines = Lines(data, offsets)
            used = lines.with_words
            rows = pa.array(lines.text[used] + at)
            columns = [
                batch.column("doc_id").take(rows), batch.column("version").take(rows), pa.array(lines.number[used].astype(np.int32)),
                pa.array(as_long(lines.keys())), pa.array(as_long(lines.checks())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "line_no", "line", "check"])


def count_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triples that occur at least twice in the different lines of a slice, with their counts there."""
    for batch in batches:
        for _, _, data, offsets in slices(batch.column("text"), 4 << 20):
            lines = Lines(data, offsets)
            grams, counts = np.unique(lines.grams(lines.senders())[0], return_counts=True)
            often = counts > 1
            yield pa.RecordBatch.from_arrays([pa.array(as_long(grams[often])), pa.array(counts[often])], names=["gram", "n"])


def by_owner(grams: np.ndarray, is_common: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order by owner, then the common ones last, then hash."""
    if len(owner) and owner[-1] < 1 << 16:
        short = owner.astype(U64) << U64(48) | is_common.astype(U64) << U64(47) | grams >> U64(17)
        order = np.argsort(short, kind="stable")
        short, sorted_grams = short[order], grams[order]
        if not ((short[1:] == short[:-1]) & (sorted_grams[1:] != sorted_grams[:-1])).any():
            return order
    return np.lexsort((grams, is_common, owner))


def sent(lines: Lines, senders: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The triples that lines send as keys, and the number of the line (within ``senders``) of each.

    ``common`` has the sorted triples that come last in the order.
    """
    grams, place, owner = lines.grams(senders)
    top = np.zeros(1 << 20, dtype=bool)
    top[common >> U64(44)] = True
    is_common = top[grams >> U64(44)]
    is_common[is_common] = np.isin(grams[is_common], common)
    order = by_owner(grams, is_common, owner)
    places, edges = place[order].tolist(), np.searchsorted(owner, np.arange(len(senders) + 1)).tolist()
    needed = (np.floor(lines.n[senders] * (1 - SIMILAR) / SIMILAR + 1e-9).astype(int) + 1).tolist()
    free, overlapped = bytearray(b"\1") * (len(lines.hashes) + 2 * GRAM), bytes(2 * GRAM - 1)
    taken = np.zeros(len(grams), dtype=bool)
    for i, left in enumerate(needed):
        to = edges[i]
        while left and to < edges[i + 1]:
            p = places[to]
            to += 1
            if free[p + GRAM]:
                left -= 1
                free[p + 1 : p + 2 * GRAM] = overlapped
        taken[edges[i] : to] = True
    grams, owner = grams[order], owner[order]
    taken[1:] &= (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[taken], owner[taken]


FLIPS = [f"f{k}" for k in range(KEY_LONGS)]
#: What is zero for most lines comes first, so it takes little room in a shuffle; ``key`` has the words above the bucket.
KEYS = [*FLIPS[1:], "key", "id", "f0"]


def keys_of(common: np.ndarray | None):
    """The triples that lines send, or without ``common`` their SimHash blocks, with the line's small sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                lines = Lines(data, offsets)
                senders = lines.senders()
                at = np.searchsorted(lines.with_words, senders)
                ids = as_long(lines.keys()[at])
                new = np.array([k not in known for k in ids.tolist()], dtype=bool)
                senders, ids, at = senders[new], ids[new], at[new]
                if not len(senders):
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                known.update(ids.tolist())
                buckets, owner = blocks_of(lines, senders) if common is None else sent(lines, senders, common)
                buckets = mix(buckets) >> U64(64 - KEY_BITS) & ~U64(1) | U64(common is not None)
                keys = buckets | np.minimum(lines.n[senders], KEY_WORDS).astype(U64)[owner] << U64(KEY_BITS)
                columns = {"key": as_long(keys), "id": ids[owner]}
                columns |= {f: as_long(x[at][owner]) for f, x in zip(FLIPS, lines.flips(), strict=True)}
                yield pa.RecordBatch.from_pydict({c: pa.array(columns[c]) for c in KEYS})

    return run


BUCKET = (1 << KEY_BITS) - 1
MET = "bucket long, a long, b long, closest boolean"


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the keys bring, of rows that come by bucket, then size and id.

    Pairs (a, b) that may be similar, without a bucket; ``closest`` if b is the closest to a there. Of triples
    that more than ``SMALL`` lines share, the rows (bucket, a).
    """
    held = {c: np.zeros(0, np.int64) for c in KEYS}
    waiting: list[pa.RecordBatch] = []
    large = -1

    def taken(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket, n, ids = rows["key"] & BUCKET, rows["key"] >> KEY_BITS, rows["id"]
        starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        sizes = np.diff(np.append(starts, len(bucket)))
        size, place = np.repeat(sizes, sizes), np.arange(len(bucket)) - np.repeat(starts, sizes)
        triple = bucket & 1 == 1
        many = triple & ((size > SMALL) | (bucket == large))
        none = np.zeros(0, np.int64)
        yield met(bucket[many], ids[many], none, none.astype(bool))
        flips = [rows[f].view(U64) for f in FLIPS]
        folded = np.bitwise_xor.reduce(flips)
        best = np.full(len(bucket), 1 << 40)
        partner = np.zeros(len(bucket), np.int64)
        others = []
        for d in range(1, SMALL):
            y = np.flatnonzero((place >= d) & ~many & (triple | (d <= NEXT)))
            if not len(y):
                break
            x = y - d
            most = 2 * np.floor(np.maximum(n[x], n[y]) * (1 - SIMILAR) + 1e-9).astype(np.int64) - np.abs(n[x] - n[y])
            apart = np.bitwise_count(folded[x] ^ folded[y]).astype(np.int64)
            apart[(n[x] == KEY_WORDS) | (n[y] == KEY_WORDS)] = -1  # may have more words
            ok = (apart <= most) | (apart < 0)
            x, y, most, apart = x[ok], y[ok], most[ok], apart[ok]
            long = np.flatnonzero((n[x] > SHORT) & (n[y] > SHORT) & (apart >= 0))
            apart[long] = sum(np.bitwise_count(f[x[long]] ^ f[y[long]]).astype(np.int64) for f in flips)
            ok = (apart <= most) | (apart < 0)
            x, y, apart = x[ok], y[ok], apart[ok]
            nearer = apart < best[y]
            best[y[nearer]], partner[y[nearer]] = apart[nearer], x[nearer]
            others.append((y[triple[y]], x[triple[y]]))
        y = np.flatnonzero(best < 1 << 40)
        yield met(None, ids[y], ids[partner[y]], np.ones(len(y), bool))
        if others:
            y, x = (np.concatenate(part) for part in zip(*others, strict=True))
            y, x = y[partner[y] != x], x[partner[y] != x]
            yield met(None, ids[y], ids[x], np.zeros(len(y), bool))

    def met(bucket: np.ndarray | None, a: np.ndarray, b: np.ndarray, closest: np.ndarray) -> pa.RecordBatch:
        if bucket is not None:
            columns = [pa.array(bucket), pa.array(a), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.bool_())]
        else:
            columns = [pa.nulls(len(a), pa.int64()), pa.array(a), pa.array(b), pa.array(closest)]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "a", "b", "closest"])

    def rows(last: bool) -> Iterator[pa.RecordBatch]:
        """All that is waiting, but the last bucket, which may go on."""
        nonlocal held, large
        new = {c: np.concatenate([held[c], *(x.column(c).to_numpy() for x in waiting)]) for c in KEYS}
        waiting.clear()
        again = (new["key"][1:] == new["key"][:-1]) & (new["id"][1:] == new["id"][:-1])
        if again.any():
            new = {c: x[np.concatenate(([True], ~again))] for c, x in new.items()}
        bucket = new["key"] & BUCKET
        end = len(bucket)
        if not last and end:
            end = int(np.searchsorted(bucket, bucket[-1]))
            if len(bucket) - end > SMALL:  # large whatever follows: only its last rows wait
                end, large = len(bucket) - NEXT, int(bucket[-1])
        held = {c: x[end:] for c, x in new.items()}
        if end:
            yield from taken({c: x[:end] for c, x in new.items()})

    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= MEET_ROWS:
            yield from rows(False)
    yield from rows(True)


def line_codes(sketch_longs: int):
    """Key and word sequence of every line that sends keys, and its parity sketch of so many longs.

    The sequence has a character beyond the basic plane for each word. In the sketch every word flips one
    bit, so an edit changes at most two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                lines = Lines(data, offsets)
                code = (0x10000 + lines.hashes % U64(0xF0000)).astype(np.uint32)
                utf8 = np.stack([0xF0 | code >> 18, 0x80 | code >> 12 & 0x3F, 0x80 | code >> 6 & 0x3F, 0x80 | code & 0x3F], axis=1).astype(np.uint8)
                edges = pa.py_buffer((4 * lines.bounds).astype(np.int32))
                codes = pa.StringArray.from_buffers(len(lines.n), edges, pa.py_buffer(utf8)).take(pa.array(lines.with_words))
                columns = [pa.array(as_long(lines.keys())), codes]
                starts = lines.bounds[:-1][lines.with_words]
                bits = U64(1) << (lines.hashes & U64(63))
                part = (lines.hashes >> U64(6)) % U64(max(sketch_longs, 1))
                for k in range(sketch_longs):
                    flips = np.where(part == U64(k), bits, U64(0))
                    columns.append(pa.array(as_long(np.bitwise_xor.reduceat(flips, starts) if len(starts) else flips)))
                rows = pa.RecordBatch.from_arrays(columns, names=["line", "codes", *sketch_parts(sketch_longs)])
                yield rows.filter(pa.array(lines.n[lines.with_words] >= FEWEST_WORDS))

    return run


def sketch_parts(sketch_longs: int) -> list[str]:
    return [f"p{k}" for k in range(sketch_longs)]


def without_lines(schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept, dropped = batch.column("text"), [], []
            for i, gone in enumerate(batch.column("_gone")):
                gone = set(gone.as_py() or ())
                text = texts[i].as_py()
                if gone:
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                kept.append(text)
                dropped.append(len(gone))
            columns = [pa.array(kept, pa.string()) if name == "text" else batch.column(name) for name in schema_names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(dropped, pa.int32())], names=[*schema_names, "n_dropped"])

    return run


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if it has few rows; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.count() <= SMALL_SIDE_ROWS else df


def most_edits(a: Column, b: Column) -> Column:
    """Edits that lines of so many words may need and still be similar."""
    return F.floor(F.greatest(a, b) * (1 - SIMILAR) + 1e-9).cast("int")


def within_edits(a: Column, b: Column) -> Column:
    """Whether two parity sketches leave room for similar lines.

    At least as many edits are needed as the line with more words of its own has such words.
    """
    apart = sum((F.bit_count(a[p].bitwiseXOR(b[p])) for p in sketch_parts(SKETCH_LONGS)), F.lit(0))
    most = most_edits(a["n"], b["n"])
    return apart + F.abs(a["n"] - b["n"]) <= 2 * most


def line_groups(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(line, check, n_rows, first, best): every distinct line, its first place, and the first of its group."""
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "line_no")
    firsts = written(lines.groupBy("line", "check").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n_rows")))
    texts = docs.select("text")
    common = (
        map_arrow(texts, count_common, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "gram").limit(COMMON_GRAMS).select("gram").toArrow().column("gram").to_numpy()
    )

    def brought(common: np.ndarray | None) -> DataFrame:
        keys = map_arrow(texts, keys_of(common), ", ".join(f"{c} long" for c in KEYS))
        bucket = F.col("key").bitwiseAND(F.lit(BUCKET))
        return written(map_arrow(keys.repartition(bucket).sortWithinPartitions(bucket, "key", "id"), meet, MET))

    prints = brought(None)
    release_shuffles(docs.sparkSession)
    grams = brought(np.sort(common.view(U64)))
    release_shuffles(docs.sparkSession)
    met = prints.union(grams)
    large = met.where("bucket IS NOT NULL").select("bucket", F.col("a").alias("id"))
    every = written(shared_buckets(large))
    shared = distinct_sets(every)
    discard(every)
    ids = met.where("bucket IS NULL").select(F.explode(F.array("a", "b")).alias("line")).union(shared.select("id"))
    needed = written(ids.distinct())
    parts = sketch_parts(SKETCH_LONGS)
    schema = ", ".join(["line long", "codes string", *(f"{p} long" for p in parts)])
    found = map_arrow(texts, line_codes(SKETCH_LONGS), schema).join(small_side(needed), "line", "left_semi")
    sketch = F.struct(F.char_length("codes").alias("n"), *parts).alias("sketch")
    codes = written(found.dropDuplicates(["line"]).select(F.col("line").alias("id"), "codes", sketch))
    discard(needed)

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for side in "ab":
            both = both.join(codes.select(F.col("id").alias(side), F.col("codes").alias(f"{side}_codes"), F.col("sketch").alias(f"{side}_sketch")), side)
        both = both.where(within_edits(F.col("a_sketch"), F.col("b_sketch")))
        most = most_edits(F.char_length("a_codes"), F.char_length("b_codes"))
        return both.where(F.call_function("levenshtein", "a_codes", "b_codes", most) >= 0).select("a", "b")

    first = written(verify(met.where("closest").select("a", "b")))
    near = written(components(first))
    apart = with_component(with_component(met.where("NOT closest").select("a", "b"), near, "a"), near, "b").where("a_component <> b_component")
    known = written(first.union(verify(apart)))
    discard(first, near, prints, grams)
    facts = codes.select("id", F.col("sketch").alias("info"))
    groups = linked_groups(shared, facts, within_edits, verify, known=known).select(F.col("id").alias("line"), "component")
    discard(shared, codes, known)
    # A line without a link is told from others by all its 128 bits, one of a group by the group.
    alone = F.when(F.col("component").isNull(), F.col("check")).alias("own")
    named = firsts.select("line", "check", "first", "n_rows").join(groups, "line", "left")
    named = written(named.select("line", "check", "first", "n_rows", F.coalesce("component", "line").alias("component"), F.coalesce(alone, F.lit(0)).alias("own")))
    best = named.groupBy("component", "own").agg(F.min("first").alias("best"))
    discard(firsts)
    return named.join(best, ["component", "own"]).select("line", "check", "n_rows", "first", "best")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of each group but the first occurrence taken out of ``text``; n_dropped counts them.

    Lines end at newlines; a line without a word (also one of punctuation only) is never dropped. A text
    that is NULL stays NULL. Rows that repeat both doc_id and text are one document: they lose the same
    lines. Rows without doc_id come last. Other columns pass through; a column called n_dropped gives way.
    """
    docs = docs.drop("n_dropped").withColumn("text", F.col("text").cast("string"))
    versioned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    lines = written(map_arrow(versioned, describe_lines, LINES))
    repeated = line_groups(docs, lines).where("n_rows > 1 OR first <> best").select("line", "check", "best")
    here = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version", "line_no")
    # Rows that repeat a document bring each of its lines twice; both are at the same place.
    gone = (
        lines.join(repeated, ["line", "check"]).where(~here.eqNullSafe(F.col("best"))).groupBy("doc_id", "version")
        .agg(F.sort_array(F.collect_set("line_no")).alias("gone")).toDF("_doc", "_version", "_gone")
    )
    keyed = docs.withColumn("_v", F.xxhash64("text"))
    joined = keyed.join(gone, keyed["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (F.col("_v") == F.col("_version")), "left")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_dropped", T.IntegerType())])
    return map_arrow(joined.select(*docs.columns, "_gone"), without_lines(docs.columns), schema)
