"""How many candidates the operators on pairs make, and that none is lost on the way."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidelake.llm import line_dedup, linking, parity_join
from tidelake.llm.tables import written
from tidelake.llm.textkit import slices


def joined_rows(df):
    """Rows that the joins of ``df`` put out, the largest number first."""
    df.collect()
    left, found = [df._jdf.queryExecution().executedPlan()], []
    while left:
        node = left.pop()
        if "Join" in node.nodeName():
            found.append(node.metrics().get("numOutputRows").get().value())
        kind = node.getClass().getSimpleName()
        inner = "executedPlan" if kind == "AdaptiveSparkPlanExec" else "plan" if kind.endswith("QueryStageExec") else None
        left += [getattr(node, inner)()] if inner else [node.children().apply(k) for k in range(node.children().size())]
    return sorted(found, reverse=True)


def test_a_pair_that_meets_in_many_buckets_is_told_once(spark):
    ids, buckets = range(60), range(40)
    rows = [(b, i, min(j for j in ids if j != b), 1) for b in buckets for i in ids if i != b]
    shared = written(spark.createDataFrame(rows, "bucket long, id long, star long, info int"))
    most = []

    def verify(pairs):
        most.append(max([0, *joined_rows(pairs)]))
        return pairs.where("a % 7 = b % 7")

    groups = linking.linked_groups(shared, None, lambda a, b: a == b, verify)
    assert {(r.id, r.component) for r in groups.collect()} == {(i, i % 7) for i in ids}
    assert 0 < max(most) <= 60 * 59 / 2 * 1.1


def lines_of(texts):
    _, _, data, offsets = next(slices(pa.array(texts), 1 << 30))
    return line_dedup.Lines(data, offsets)


def test_line_dedup_keeps_no_table_of_keys(spark, monkeypatch):
    """Lines that share triples but are not similar leave few candidates behind."""
    rng = random.Random(3)
    vocabulary = ["w%s" % chr(97 + k) for k in range(20)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(20, 40))) for _ in range(1500)]
    rows = []

    def counted(df):
        out = written(df)
        rows.append(out.count())
        return out

    for module in (line_dedup, linking):
        monkeypatch.setattr(module, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert line_dedup.dedup_lines(docs).where("n_dropped > 0").count() == 0
    assert sum(rows) < 6 * len(texts)


def test_pairs_and_large_sets_come_whole_from_rows_in_pieces(monkeypatch):
    """All pairs of up to SMALL rows that a triple brings, and all rows of more, wherever a piece ends."""
    monkeypatch.setattr(line_dedup, "MEET_ROWS", 40)
    rng = random.Random(4)
    keys, want_pairs, want_large, at = [], set(), set(), 0
    for bucket, size in enumerate([1, 2, 31, 32, 33, 70, 5, 200, 1, 32, 34, 3]):
        bucket = 2 * bucket + 1
        members = [(bucket | 12 << line_dedup.KEY_BITS, at + k) for k in range(size)]
        at += size
        keys += members + rng.choices(members, k=3)
        if size > line_dedup.SMALL:
            want_large |= {(bucket, i) for _, i in members}
        else:
            want_pairs |= {(a, b) for _, a in members for _, b in members if a < b}
    keys.sort(key=lambda x: (x[0] & line_dedup.BUCKET, *x))
    zeros = {c: [0] * len(keys) for c in line_dedup.KEYS}
    table = pa.table(zeros | {"key": [k for k, _ in keys], "id": [i for _, i in keys]})
    got = pa.Table.from_batches(line_dedup.meet(iter(table.to_batches(max_chunksize=7)))).to_pylist()
    assert {(r["bucket"], r["a"]) for r in got if r["b"] is None} == want_large
    assert {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in got if r["b"] is not None} == want_pairs


def test_small_sketches_differ_by_two_bits_an_edit_at_most():
    rng = random.Random(6)
    for n in (20, 127, 128, 129, 140, 400):
        base = ["v%d" % rng.randrange(900) for _ in range(n)]
        other = list(base)
        for _ in range(n // 10):
            other[rng.randrange(len(other))] = "x%d" % rng.randrange(900)
        flips = line_dedup.Lines.flips(lines_of([" ".join(base), " ".join(other)]))
        if n > line_dedup.SHORT:
            assert sum((int(f[0]) ^ int(f[1])).bit_count() for f in flips) <= 2 * (n // 10)
        folded = [0, 0]
        for f in flips:
            folded = [folded[0] ^ int(f[0]), folded[1] ^ int(f[1])]
        assert (folded[0] ^ folded[1]).bit_count() <= 2 * (n // 10)


def members_and_buckets(rng, stars, size, buckets):
    """Members (star, id, n, component, sketch) and rows (star, bucket, id), with the pairs that are close in a bucket."""
    members, rows, want = [], [], set()
    for star in range(stars):
        base = rng.integers(0, 2, 8192)
        ids = np.sort(rng.choice(10**6, size, replace=False)) + 10**6 * star
        n = np.where(rng.random(size) < 0.7, rng.integers(300, 420, size), rng.integers(1500, 2000, size))
        component = rng.integers(0, max(2, size // 3), size) + 10**7 * star
        flips = [rng.choice(8192, rng.integers(0, max(1, k // 4)), replace=False) for k in n]
        bits = [np.where(np.isin(np.arange(8192), f), 1 - base, base) for f in flips]
        sketches = [np.packbits(b.reshape(-1, parity_join.wide_bits(int(k)) if k > 1024 else 2048).sum(axis=0) % 2).view(np.int64) for b, k in zip(bits, n)]
        members += [(star, int(i), int(k), int(c), x.tolist()) for i, k, c, x in zip(ids, n, component, sketches)]
        for bucket in range(buckets):
            here = np.flatnonzero(rng.random(size) < rng.random())
            rows += [(star, 5 * bucket, int(ids[k])) for k in here]
            for a in here:
                for b in here[here > a]:
                    apart = 7 * parity_join.bits_apart(sketches[a].view(np.uint64), sketches[b].view(np.uint64))
                    alike = component[a] == component[b] or 4 * min(n[a], n[b]) < 3 * max(n[a], n[b])
                    if not alike and apart <= n[a] + n[b]:
                        want.add((int(ids[a]), int(ids[b]), int(1000 * apart // (n[a] + n[b]))))
    return members, rows, want


@pytest.mark.parametrize("stars, size, buckets", [(40, 5, 4), (3, 90, 25), (1, 150, 3), (4, 1, 2)])
def test_members_of_a_star_meet_wherever_rows_and_flags_are_cut(monkeypatch, stars, size, buckets):
    members, rows, want = members_and_buckets(np.random.default_rng(size), stars, size, buckets)
    table = [(s, None, i, n, c, x, 0, 0) for s, i, n, c, x in members] + [(s, b, i, None, None, None, 0, 0) for s, b, i in rows]
    table.sort(key=lambda r: (r[0], r[2], r[1] is not None, r[1]))
    names = ["star", "bucket", "id", "n", "component", "sketch", "cell", "side"]
    types = [pa.list_(pa.int64()) if c == "sketch" else pa.int64() for c in names]
    table = pa.table({c: pa.array(column, kind) for c, kind, column in zip(names, types, zip(*table))})
    for held, few in ((parity_join.MEET_HELD, parity_join.MEET_ROWS), (64, 20)):
        monkeypatch.setattr(parity_join, "MEET_HELD", held)
        monkeypatch.setattr(parity_join, "MEET_ROWS", few)
        got = [r for batch in parity_join.meet(iter(table.to_batches(max_chunksize=7))) for r in batch.to_pylist()]
        assert {(r["a"], r["b"], r["gap"]) for r in got} == want
        if size == 90:  # dense: told once, however many buckets a pair meets in
            assert len(got) == len(want)


def test_a_star_with_many_members_is_dealt_out_in_cells(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "CELL", 16)
    members, rows, want = members_and_buckets(np.random.default_rng(8), 2, 60, 6)
    component = {i: c for _, i, _, c, _ in members}
    mixed = spark.createDataFrame([(b + 1000 * s, s, i, component[i]) for s, b, i in rows], "bucket long, star long, id long, component long")
    sets = spark.createDataFrame([(i, n, x) for _, i, n, _, x in members], "id long, n long, sketch array<long>")
    got = [(r.a, r.b, r.gap) for r in parity_join.met_by_star(mixed, sets).collect()]
    assert len(got) == len(want) and set(got) == want


def test_a_large_family_is_joined_without_verifying_all_its_pairs(spark, monkeypatch):
    """Near copies on both sides of the threshold: the groups of brute force, from few pairs whose texts are fetched."""
    rng = random.Random(9)
    vocabulary = ["w%d" % k for k in range(3000)]
    base, texts = rng.choices(vocabulary, k=200), []
    for _ in range(220):
        words = list(base)
        for _ in range(int(rng.triangular(0, 14, 6))):
            words[rng.randrange(200)] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    long = rng.choices(vocabulary, k=40)  # in texts whose small sketches are full
    texts += [" ".join(rng.choices(vocabulary, k=6000) + long) for _ in range(30)]
    sets = [{tuple(words[k : k + 5]) for k in range(len(words) - 4)} for words in map(str.split, texts)]
    group = list(range(len(texts)))
    for b in range(len(sets)):
        for a in range(b):
            if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                old, new = sorted((group[a], group[b]))[::-1]
                group = [new if g == old else g for g in group]
    verified = []

    def counted(df):
        out = written(df)
        if df.columns == ["a", "b"]:
            verified.append(out.count())
        return out

    monkeypatch.setattr(parity_join, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in parity_join.near_duplicates(docs).collect()} == dict(enumerate(group))
    assert 20 < len(set(group)) and sum(verified) < 5 * len(texts), verified
