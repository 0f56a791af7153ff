import random

import pytest

from lakeweir.llm.spotjoin import length_borders, similar_spots, verified
from tests.llm.test_spotsigs import likeness, signs


def brute(rows, percent):
    sets = [signs(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def spots(*names):
    return " ".join(f"the left{n} right{n}." for n in names)


def corpus(seed):
    """Texts with one signature in all, families that drift apart, equal sets, and short ones."""
    rng = random.Random(seed)
    texts = [None, "", "###", "one two three", "one two three"]
    for family in range(6):
        own = [f"f{family}x{i}" for i in range(rng.choice((4, 5, 9, 10, 24, 60)))]
        for _ in range(8):
            again = ["hot"] + own
            for _ in range(rng.randrange(1 + len(own) // 6)):
                again[rng.randrange(1, len(again))] = f"n{rng.randrange(30)}"
            texts.append(spots(*again[: len(again) - rng.randrange(1 + len(own) // 8)]))
            if rng.random() < 0.2:
                texts.append(texts[-1].replace("the", "of the"))
    texts += [spots("hot", *(rng.randrange(12) for _ in range(6))) for _ in range(30)]
    return list(enumerate(texts, 1))


@pytest.mark.parametrize(("seed", "percent", "block", "rounds"), [(2, 80, 3, 1), (3, 60, 4, 3), (1, 80, 1000, 1), (4, 90, 3, 1)])
def test_as_brute_force(frame, monkeypatch, seed, percent, block, rounds):
    monkeypatch.setattr("lakeweir.llm.spotjoin.BLOCK_MEMBERS", block)
    monkeypatch.setattr("lakeweir.llm.spotjoin.MOST_ROUNDS", rounds)
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    got = sorted(tuple(r) for r in similar_spots(frame(rows), percent=percent).collect())
    want = brute(rows, percent)
    assert got == want
    assert 1 < len({c for _, _, c in want}) < len(rows)


@pytest.mark.parametrize("size", [4, 5, 8, 9, 10])
def test_just_like_enough(frame, size):
    rows = [(1, spots(*range(size))), (2, spots(*range(size + 1))), (3, spots(*range(50, 50 + size))), (4, spots(*range(50, 49 + size), 99))]
    assert sorted(tuple(r) for r in similar_spots(frame(rows)).collect()) == brute(rows, 80)


@pytest.mark.parametrize("percent", [50, 66, 80, 99])
def test_partners_are_in_the_next_partition(percent):
    borders = length_borders(percent)
    for size in range(1, 3000):
        at, most = (sum(b <= s for b in borders) for s in (size, 100 * size // percent))
        assert most - at <= 1


def test_no_pair_is_lost_for_near_misses(frame):
    a, b = signs(spots(*range(10))), signs(spots(*range(1, 10), 77))
    assert likeness(a, b) == pytest.approx(9 / 11)
    rows = [(5, spots(*range(10))), (3, spots(*range(1, 10), 77)), (4, spots(*range(2, 10), 77, 78))]
    assert {r["component_id"] for r in similar_spots(frame(rows)).collect()} == {3}


def test_awkward_rows(awkward):
    got = similar_spots(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r["n_signatures"] == 0 and r["component_id"] == r["doc_id"] for r in got if r["doc_id"] in (2, 3))


def test_no_python_in_the_plan(frame):
    plan = similar_spots(frame(corpus(5)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def shuffled_rows(df):
    """Rows that the exchanges of a frame's plan write when it is collected."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_only_sets_of_pairs_move(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sets = spark.createDataFrame([(i, list(range(10 * (i // 2), 10 * (i // 2) + 9 + i % 2))) for i in range(4000)], "set_key long, signs array<long>")
    pairs = spark.createDataFrame([(0, 1), (1, 2), (3998, 3999), (5, 9999)], "u long, v long")
    found = verified(pairs, sets, 80)
    assert sorted(map(tuple, found.collect())) == [(0, 1), (3998, 3999)]
    assert shuffled_rows(found) < 100


def test_no_rows_and_limits(frame):
    assert similar_spots(frame([])).collect() == []
    with pytest.raises(ValueError, match="percent"):
        similar_spots(frame([]), percent=100)
