"""Clustering, against plain k-means in integers."""

import hashlib
import random

import numpy as np
import pytest

from lakeweir.llm import shallot
from lakeweir.llm.shallot import Block, Centroids, clustered, integer_vectors, squared

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance string, v int"


def brute(rows, size, k, rounds=5, scale=256):
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of all rows, sorted."""
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == size and all(x is not None and np.isfinite(x) for x in e):
            kept.append((vec_id, [int(np.floor(scale * float(np.float32(x)))) for x in e]))
    if not kept:
        return []
    key = lambda r: ("z" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, found, strict=True) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    found = assign()
    total = sum(d for _, d in found)
    per = [sum(d for c, d in found if c == j) for j in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, per[c], total, sha[c]) for (i, _), (c, d) in zip(kept, found, strict=True))


def got(df, size, k, **how):
    return sorted((str(r[0]), *r[1:]) for r in map(tuple, clustered(integer_vectors(df, size, 256), size, k, **how).collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, "x", 3) for i, e in rows], SCHEMA)


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(shallot, "BLOCK_ROWS", 16)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(3)]) for i in range(120)]
    rows += rows[:20] + [(7, [9.0, 9.0, 9.0])] * 3 + [(None, [1.0, 1.0, 1.0])]
    rows += [(900, None), (901, []), (902, [1.0, None, 1.0]), (903, [1.0, float("nan"), 1.0]), (904, [float("inf"), 0.0, 0.0]), (905, [1.0] * 4)]
    assert got(frame(spark, rows), 3, 11) == brute(rows, 3, 11)


@pytest.mark.parametrize("k", [1, 2, 40])
def test_fewer_vectors_than_centroids_and_equal_ones(spark, k):
    rows = [(i, [0.5, 0.5]) for i in range(12)]
    assert got(frame(spark, rows), 2, k) == brute(rows, 2, k)


def test_empty_table(spark):
    out = clustered(integer_vectors(frame(spark, []), 2, 256), 2)
    assert out.collect() == [] and out.columns[:3] == ["vec_id", "cluster", "distance"]


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="would not fit 64 bits"):
        got(frame(spark, [(1, [1e30, 0.0])]), 2, 1)


def test_search_is_exact_and_bounds_save_work():
    rng = np.random.default_rng(11)
    middles = rng.integers(-4000, 4000, (30, 8))
    x = (middles[rng.integers(0, 30, 3000)] + rng.integers(-200, 200, (3000, 8))).astype(np.int64)
    block, places, before, searched = Block(x), x[:25].copy(), None, []
    for _ in range(8):
        block.assign(Centroids(places, before))
        searched.append(block.searched)
        d = np.stack([squared(x, c) for c in places], 1)
        assert (block.nearest == d.argmin(1)).all()
        assert (block.upper >= np.sqrt(d.min(1)) * (1 - 1e-9)).all()
        second = np.sort(d, 1)[:, 1]
        assert (block.lower <= np.sqrt(second) * (1 + 1e-9)).all()
        sums, counts = block.sums(len(places))
        before, places = places, np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], places)
    assert searched[-1] < len(x) / 4


def test_states_of_earlier_rounds_are_freed(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(shallot.shared_folder(spark) + "/llm")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(30)]
    names = lambda: {p.getPath().toString() for p in fs.listStatus(folder) if "shallot" in p.getPath().getName()}
    fs.mkdirs(folder)
    before = names()
    got(frame(spark, rows), 2, 4)
    (made,) = names() - before
    assert [p.getPath().getName() for p in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(made))] == ["5"]
