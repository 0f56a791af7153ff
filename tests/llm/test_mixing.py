import random
from collections import defaultdict

import numpy as np
import pytest

from lakeweir.llm.mixing import mixed, pair_up


def targets_of(sizes):
    """Shares by weight; what is above three times a source's size goes to the others."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    left, open_ones = float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_ones:
        total = sum(weight[s] for s in open_ones)
        for s in open_ones:
            target[s] += left * weight[s] / total
        left = sum(max(0.0, target[s] - 3 * sizes[s]) for s in open_ones)
        for s in list(open_ones):
            if target[s] >= 3 * sizes[s]:
                target[s] = 3.0 * sizes[s]
                open_ones.discard(s)
    return target


@pytest.fixture
def docs(frame):
    rng = random.Random(3)
    sources = ["a"] * 300 + ["b"] * 80 + ["c"] * 10 + [None] * 40 + ["é"] * 60 + ["Z"] * 25
    return frame([(i, " ".join(["w"] * rng.randint(1, 60)), "en", s) for i, s in enumerate(sources)])


def test_targets_and_taken_words(docs, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.mixing.FAN_IN", 7)
    rows = mixed(docs, keep=["source"]).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    target = targets_of(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixed(docs, keep=["source"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_awkward_rows(awkward):
    rows = mixed(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert sorted(r["size"] for r in rows if r["doc_id"] == 1) == [9, 9]


def test_no_rows_and_no_words(frame):
    assert mixed(frame([])).collect() == []
    assert [(r["size"], r["target"], r["taken"]) for r in mixed(frame([(1, None), (2, "")])).collect()] == [(0, 0.0, 0)] * 2


def test_pairs_keep_words_and_expectations():
    rng = np.random.default_rng(5)
    sizes, start = rng.integers(1, 50, 30).astype(float), rng.random(30)
    total = np.zeros(30)
    for _ in range(3000):
        out = pair_up(sizes, start, rng.random(30))
        assert sizes @ out == pytest.approx(sizes @ start)
        assert np.count_nonzero((out > 0) & (out < 1)) <= 1
        total += out
    assert np.abs(total / 3000 - start).max() < 0.05
