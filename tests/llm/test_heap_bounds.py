import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from leadrank.llm import heap_bounds
from leadrank.llm.queries import all_queries

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, ids string, vec string, id string"


def brute_force(rows, clusters=16, rounds=3, seed=1, dims=64, scale=64):
    """(id, cluster, distance, centroid) of each vector that takes part, in whole numbers."""
    kept = [
        (i, [math.floor(scale * Fraction(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = {k: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "", v) for k, (i, v) in enumerate(kept)}
    centroids = [kept[k][1] for k in sorted(digest, key=digest.get)[:clusters]]

    def assigned():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assigned()
        for k in range(len(centroids)):
            mine = [v for (_, v), (own, _) in zip(kept, of) if own == k]
            if mine:
                centroids[k] = [sum(c) // len(mine) for c in zip(*mine)]
    of = assigned()
    top = (1 << 63) - 1
    sums = [min(top, sum(d for own, d in of if own == k)) for k in range(len(centroids))]
    whole = min(top, sum(d for _, d in of))
    return sorted(
        ((i, own, min(top, d), sums[own], whole, ",".join(map(str, centroids[own]))) for (i, _), (own, d) in zip(kept, of)), key=repr
    )


def found(spark, rows, **how):
    vectors = spark.createDataFrame([(i, v, *"abcde") for i, v in rows], SCHEMA).repartition(3)
    made = heap_bounds.cluster(vectors, **how).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, ",".join(r.centroid)) for r in made), key=repr)


def points(rng, n, centres, spread, dims=64):
    return [[x + rng.gauss(0, spread) for x in rng.choice(centres)[:dims]] for _ in range(n)]


def test_random_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(64)]) for i in range(300)]
    assert found(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("clusters,rounds", [(1, 2), (2, 0), (3, 1), (7, 6)])
def test_numbers_of_clusters_and_rounds(spark, clusters, rounds):
    rng = random.Random(clusters)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(80)]
    assert found(spark, rows, clusters=clusters, rounds=rounds) == brute_force(rows, clusters, rounds)


def test_ties_and_repeated_rows(spark):
    rng = random.Random(3)
    # Few values each, so that many distances are equal.
    rows = [(i % 40, [float(rng.choice([0, 0, 0, 1])) / 64 for _ in range(64)]) for i in range(150)] + [(7, [0.0] * 64)] * 30
    assert found(spark, rows, clusters=9, rounds=4) == brute_force(rows, 9, 4)


def test_rows_that_take_no_part(spark):
    rng = random.Random(4)
    good = [(i, [rng.random() for _ in range(64)]) for i in range(5)]
    bad = [(10, None), (11, []), (12, [1.0] * 63), (13, [1.0] * 65), (14, [None] * 64), (15, [float("nan")] * 64), (16, [0.0] * 63 + [float("-inf")])]
    rows = good + bad + [(None, [0.5] * 64), (None, [0.25] * 64)]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows, clusters=2) == brute_force(rows, 2)
    assert found(spark, bad) == [] and found(spark, []) == []


def test_components_of_any_size(spark):
    rng = random.Random(5)
    sizes = [1e-9, 1.0, 3e3, 1e6, 1e9, 1e17, 1e300, 1.7e308]
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * sizes[i % k] for _ in range(64)]) for k in (3, 5, 8) for i in range(24)]
    for some in (rows[:24], rows[24:48], rows):
        assert found(spark, some, clusters=4, rounds=2) == brute_force(some, 4, 2)


def test_only_expired_vectors_are_popped():
    rng = random.Random(6)
    centres = [[rng.choice([-1, 1]) * 0.5 for _ in range(64)] for _ in range(8)]
    x = heap_bounds.floors(np.array(points(rng, 600, centres, 0.02)), 64)
    centroids = heap_bounds.floors(np.array(centres), 64)
    block = heap_bounds.Block.of(x, centroids, [0.0] * 8)
    assert len(block.pop([0.5] * 8)) == 0
    popped = block.pop([1e6] * 8)
    assert len(popped) == 600 and not any(block.heaps)
    assert all(heap_bounds.Block.of(x, centroids, [0.0] * 8).clusters() == heap_bounds.squared(x, centroids).argmin(axis=1))


def test_heaps_keep_their_order_through_rounds():
    rng = np.random.default_rng(7)
    x = rng.integers(-60, 60, (500, 64))
    centroids, drift = x[:6], [0.0] * 6
    block = heap_bounds.Block.of(x, centroids, drift)
    seen = 0
    for number in range(6):
        moved = centroids + rng.integers(-2, 3, centroids.shape) // (number + 1)
        steps = [math.sqrt(((a - b) ** 2).sum()) for a, b in zip(centroids, moved)]
        drift = [d + steps[k] + max(s for j, s in enumerate(steps) if j != k) for k, d in enumerate(drift)]
        centroids = moved
        rows = block.pop(drift)
        seen += len(rows)
        block.rescan(rows, centroids, drift)
        assert (block.clusters() == heap_bounds.squared(x, centroids).argmin(axis=1)).all()
        assert all(h[0] == min(h) for h in block.heaps if h)
    assert 0 < seen < 6 * 500


@pytest.mark.parametrize("values", [[0], [1, -128], [127, 128], [-(1 << 31), 5], [1 << 62, 3], [1 << 80, -7]])
def test_matrices_as_bytes(values):
    x = np.array([values], object)
    width, data = heap_bounds.to_bytes(x)
    assert heap_bounds.from_bytes(width, data, len(values)).tolist() == [values]


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest()) for r in brute_force(rows)]
    got = all_queries()["op11_clusters"](spark, sf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
