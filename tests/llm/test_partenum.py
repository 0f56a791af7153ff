import random
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeweir.llm.graph import components
from lakeweir.llm.partenum import GramSets, forest, signatures, similar_components, size_bands, sketches

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def gram_set(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_force(rows, percent=85):
    """Components by comparing all pairs."""
    sets = [gram_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def family(rng, words, n, edits):
    """Near copies of one text, each with some words changed."""
    base = [rng.choice(words) for _ in range(n)]
    for e in edits:
        copy = list(base)
        for _ in range(e):
            copy[rng.randrange(n)] = rng.choice(words)
        yield " ".join(copy)


def corpus(seed, groups):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [t for n, edits in groups for t in family(rng, words, n, edits)]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_same_as_all_pairs(frame):
    rows = corpus(1, [(n, [0, 0, 1, 1, 2, 3, 5]) for n in (1, 3, 4, 9, 10, 30, 60, 140, 300)])
    assert result(similar_components(frame(rows))) == brute_force(rows)


def test_groups_larger_than_a_block(frame, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.partenum.BLOCK_MEMBERS", 8)
    monkeypatch.setattr("lakeweir.llm.partenum.BLOCK_GRAMS", 500)
    rows = corpus(2, [(60, [i % 4 for i in range(60)]), (200, [0, 1, 4, 8])])
    assert result(similar_components(frame(rows))) == brute_force(rows)


def test_awkward_rows(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert result(similar_components(awkward)) == brute_force(rows)


def test_no_rows(frame):
    assert similar_components(frame([])).collect() == []


@pytest.mark.parametrize("percent", [70, 85, 95])
def test_linked_sets_share_a_signature(percent):
    """The promise of the scheme, on pairs at the border of the threshold."""
    rng = random.Random(percent)
    for size in (7, 12, 40, 90, 400, 1500):
        words = [f"a{i}" for i in range(size + 3)]
        for _ in range(6):
            changed = list(words)
            while True:
                now = list(changed)
                now[rng.randrange(len(now))] = f"b{rng.random()}"
                a, b = gram_set(" ".join(words)), gram_set(" ".join(now))
                if 100 * len(a & b) < percent * len(a | b):
                    break
                changed = now
            sets = GramSets(pa.array([" ".join(words), " ".join(changed)]), 4)
            owner, values = signatures(sets, np.ones(2, bool), percent)
            if changed != words and sets.sizes.min() >= 100 // (100 - percent):
                assert set(values[owner == 0]) & set(values[owner == 1])
            parity = [np.frombuffer(p, np.uint8) for p in sketches(sets, percent)]
            if len(parity[0]) == len(parity[1]):
                apart = len(set(sets.of(0).tolist()) ^ set(sets.of(1).tolist()))
                assert np.bitwise_count(parity[0] ^ parity[1]).sum() <= apart


def test_bands_hold_linked_sizes_side_by_side():
    bands = size_bands(85, 5000)
    for size in range(1, 5000):
        largest = size * 100 // 85
        assert np.searchsorted(bands, largest, "right") - np.searchsorted(bands, size, "right") <= 1


def test_forest_reaches_what_is_near():
    near = {0: {1}, 1: {0, 2}, 2: {1}, 3: {4}, 4: {3}, 5: set()}
    edges = list(forest(6, lambda u, others: np.array([int(v) in near[u] for v in others]), None))
    assert sorted(map(sorted, edges)) == [[0, 1], [1, 2], [3, 4]]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["root"] for r in components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(df.where(F.lit(False)), "a", "b").collect() == []


@pytest.mark.parametrize("percent, size", [(80, 5), (90, 10)])
def test_smallest_sets_that_can_differ(frame, percent, size):
    texts = [" ".join(f"g{g}w{i}" for i in range(k)) for g in range(40) for k in (size - 1, size)]
    got = result(similar_components(frame(list(enumerate(texts))), n=1, percent=percent))
    assert got == sorted(((i, size - 1 + i % 2, i - i % 2) for i in range(len(texts))), key=str)


def test_five_words_at_eighty_percent(frame, monkeypatch):
    rows = corpus(6, [(n, [0, 0, 1, 1, 2, 3, 5]) for n in (4, 8, 9, 30, 60, 140, 300)])
    expected_of = partial(gram_set, n=5)
    monkeypatch.setitem(globals(), "gram_set", expected_of)
    assert result(similar_components(frame(rows), n=5, percent=80)) == brute_force(rows, 80)
