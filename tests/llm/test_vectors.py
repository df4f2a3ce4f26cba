"""Whitening and clustering of embeddings against plain numpy, and at the edges of their input."""

import hashlib
import math

import numpy as np
import pytest

from tidelake.llm import block_whitening, hadamard_clusters

SCHEMA = "vec_id long, embedding array<float>, cluster string, component string, x string"


def frame(spark, rows):
    """Vectors with columns that clash with names of outputs."""
    return spark.createDataFrame([(k, v, "c", "d", "e") for k, v in rows], SCHEMA).repartition(3)


def vectors(n, size, seed=4, scale=1.0, shift=0.0):
    rng = np.random.default_rng(seed)
    values = (rng.standard_normal((n, size)) * np.linspace(1, 3, size) * scale + shift).astype(np.float32)
    return [(k, [float(c) for c in v]) for k, v in enumerate(values)]


ODD = [(900, None), (901, []), (902, [None] + [0.0] * 63), (903, [float("nan")] * 64), (904, [float("inf")] + [0.0] * 63)]


@pytest.mark.parametrize("shift", [0.0, 5000.0])
def test_whitening_equals_numpy(spark, shift):
    rows = vectors(150, 64, shift=shift)
    repeated = rows[:3] * 40 + [(None, rows[5][1]), (500, rows[6][1])]
    got = block_whitening.whiten(frame(spark, rows + repeated + ODD + [(910, [1.0, 2.0])]), height=16).collect()
    assert len(got) == 16 * (150 + 120 + 2)
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = ((n * x - sums) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    expected = centred @ axes[:, :16] / np.sqrt(values[:16])
    exact = [sum(int(d) ** 2 for d in n * v - sums) for v in x]
    signs = {}
    for r in got:
        k = {None: 5, 500: 6}.get(r.vec_id, r.vec_id)
        assert (r.n, int(r.deviation)) == (n, exact[k])
        want = expected[k, r.component - 1]
        sign = signs.setdefault(r.component, math.copysign(1, want * r.whitened))
        assert r.whitened * sign == pytest.approx(want, abs=1e-9)
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_few_and_flat_vectors(spark):
    assert block_whitening.whiten(frame(spark, ODD)).count() == 0
    assert block_whitening.whiten(frame(spark, [])).count() == 0
    one = block_whitening.whiten(frame(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one) == [
        (k, c, 1, 0, None, None, None) for k in (1, 2) for c in (1, 2)
    ]
    flat = block_whitening.whiten(frame(spark, [(1, [0.0, 1.0, 3.0]), (2, [1.0, 1.0, 3.0]), (3, [2.0, 1.0, 3.0])])).collect()
    assert len(flat) == 9 and all((r.whitened is not None) == (r.component == 1) for r in flat)
    assert sorted(abs(r.whitened) for r in flat if r.component == 1) == pytest.approx([0, math.sqrt(1.5), math.sqrt(1.5)])


def test_deviations_beyond_64_bits_are_exact():
    x = np.array([[3 << 40, 5], [1, 1]], dtype=np.int64)
    apart = block_whitening.deviations(x, 1 << 30, [7, 9])
    assert [int(v) for v in block_whitening.squares(apart)] == [sum((int(v) * (1 << 30) - s) ** 2 for v, s in zip(row, (7, 9))) for row in x]


def test_transform_keeps_distances_and_goes_from_coarse_to_fine():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (7, 64))
    t = hadamard_clusters.transform(x, hadamard_clusters.ORDER)
    assert ((t * t).sum(axis=1) == 64 * (x * x).sum(axis=1)).all() and (t[:, 0] == x.sum(axis=1)).all()
    rows = hadamard_clusters.transform(np.eye(64, dtype=np.int64), hadamard_clusters.ORDER).T
    assert [(row[1:] != row[:-1]).sum() for row in rows] == list(range(64))


@pytest.mark.parametrize("scale", [3, 300, 10_000_000])
def test_search_equals_all_distances(scale):
    rng = np.random.default_rng(scale)
    x, points = rng.integers(-scale, scale, (500, 64)), rng.integers(-scale, scale, (40, 64))
    points[17] = points[3]  # the smaller number wins
    x[:100] = points[rng.integers(0, 40, 100)] + rng.integers(-2, 3, (100, 64))
    apart = ((x[:, None, :].astype(object) - points[None].astype(object)) ** 2).sum(axis=2)
    cluster, distance = hadamard_clusters.nearest(x, points)
    assert cluster.tolist() == [row.tolist().index(min(row)) for row in apart]
    assert distance.tolist() == [min(row) for row in apart]


def plain_clusters(rows):
    kept = [(k, [math.floor(256 * float(np.float32(c))) for c in v]) for k, v in rows]
    draw = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [x for _, x in draw[:40]]

    def assign():
        out = []
        for _, x in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(x, p)) for p in points]
            out.append((apart.index(min(apart)), min(apart)))
        return out

    for _ in range(5):
        found = assign()
        for c in range(len(points)):
            members = [x for (_, x), (own, _) in zip(kept, found) if own == c]
            if members:
                points[c] = [sum(column) // len(members) for column in zip(*members)]
    found = assign()
    inertia = [sum(d for own, d in found if own == c) for c in range(len(points))]
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted((str(k), c, d, inertia[c], sum(inertia), digests[c]) for (k, _), (c, d) in zip(kept, found))


@pytest.mark.parametrize("n", [300, 12])
def test_clusters_equal_plain_rounds(spark, n):
    rows = vectors(n, 64, scale=0.2)
    rows += [(1, rows[1][1])] * 60 + [(None, rows[2][1])]
    got = hadamard_clusters.cluster(frame(spark, rows + ODD + [(905, [0.5] * 63)])).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == plain_clusters(rows)


def test_clusters_of_nothing(spark):
    assert hadamard_clusters.cluster(frame(spark, ODD)).count() == 0
