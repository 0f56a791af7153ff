import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from lakeweir.llm.kneserney import BEFORE, FOLDS, ORDER, KneserNey, quality, with_perplexity


def plain(text):
    return BEFORE * (ORDER - 1) + " ".join((text or "").split())


def grams_of(text):
    p = plain(text)
    return [p[i : i + ORDER] for i in range(len(p) - ORDER + 1)]


def fold_of(text):
    return zlib.crc32((text or "").encode()) % FOLDS


class BruteForce:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.counts = {ORDER: Counter(g for t in texts for g in grams_of(t))}
        for k in range(ORDER - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.contexts = {}, {}
        for k, counts in self.counts.items():
            n = Counter(counts.values())
            if n[1] and n[2] and n[3]:
                y = n[1] / (n[1] + 2 * n[2])
                d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
                d = [min(i + 1, max(0.05, v)) for i, v in enumerate(d)]
            else:
                d = [0.5] * 3
            self.discounts[k] = lambda c, d=d: d[min(c, 3) - 1]
            total, mass = defaultdict(int), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                mass[g[:-1]] += self.discounts[k](c)
            self.contexts[k] = (total, mass)

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.counts[1]) + 1)
        total, mass = self.contexts[k]
        lower = self.p(gram[1:])
        if gram[:-1] not in total:
            return lower
        c = self.counts[k].get(gram, 0)
        own = (c - self.discounts[k](c)) / total[gram[:-1]] if c else 0.0
        return own + mass[gram[:-1]] / total[gram[:-1]] * lower


@pytest.fixture
def texts():
    rng = random.Random(8)
    sounds = "the and ing ter ou sh re tion of ha".split()
    return ["".join(rng.choice(sounds) + rng.choice(["", " ", "  \n"]) for _ in range(rng.randint(3, 80))) for _ in range(60)]


def test_same_as_dictionaries(frame, texts, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.kneserney.CHUNK_CHARS", 700)
    trusted, asked = texts[:40], [*texts, "ZZ!! unseen $$ 日本", None, "", " \n ", texts[0], texts[0]]
    model = KneserNey.train(frame(list(enumerate(trusted))))
    assert len({fold_of(t) for t in trusted}) == FOLDS
    brutes = [BruteForce([t for t in trusted if fold_of(t) != f]) for f in range(FOLDS)]
    rows = {r["doc_id"]: r for r in with_perplexity(frame(list(enumerate(asked))), model).collect()}
    assert len(rows) == len(asked)
    for i, text in enumerate(asked):
        grams = grams_of(text)
        assert rows[i]["n_grams"] == len(grams)
        if grams:
            expected = -sum(math.log(brutes[fold_of(text)].p(g)) for g in grams) / len(grams)
            assert rows[i]["log_perplexity"] == pytest.approx(expected)
        else:
            assert rows[i]["log_perplexity"] is None


def test_probabilities_sum_to_one(frame, texts):
    brute = BruteForce(texts)
    letters = sorted(brute.counts[1])
    for context in ("the", " of", "zzz", BEFORE * 3):
        assert sum(brute.p(context + c) for c in letters) + brute.p(context + "\x07") == pytest.approx(1)


def test_junk_goes_and_clean_text_stays(spark, frame, texts):
    docs = [(i, t, "en") for i, t in enumerate(texts)] + [(100, "QXZ!! JJ## 77@@ " * 20, "en"), (101, None, "en"), (None, texts[1], None), (102, texts[2], "zz")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(45)] + [(3, 1, 0), (100, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality(frame(docs), labels).collect()}
    assert len(rows) == len(docs)
    assert not rows[100]["keep"] and not rows[101]["keep"] and rows[101]["perplexity"] is None
    assert rows[None]["keep"] and rows[102]["keep"]
    assert sum(rows[i]["keep"] for i in range(45, 60)) >= 12


def test_copies_of_a_trusted_text_are_not_learned_for_it(frame, texts):
    model = KneserNey.train(frame([(i, t) for i, t in enumerate([*texts, texts[0], texts[0]])]))
    (one,) = with_perplexity(frame([(0, texts[0])]), model).collect()
    brute = BruteForce([t for t in texts if fold_of(t) != fold_of(texts[0])])
    grams = grams_of(texts[0])
    assert one["log_perplexity"] == pytest.approx(-sum(math.log(brute.p(g)) for g in grams) / len(grams))


def test_one_trusted_text_is_not_left_out(frame, texts):
    model = KneserNey.train(frame([(0, texts[0])]))
    brute = BruteForce([texts[0]])
    for row, text in zip(sorted(with_perplexity(frame(list(enumerate(texts[:6]))), model).collect()), texts, strict=False):
        grams = grams_of(text)
        assert row["log_perplexity"] == pytest.approx(-sum(math.log(brute.p(g)) for g in grams) / len(grams))


def test_nothing_trusted(spark, frame):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    (row,) = quality(frame([(1, "some text")]), labels).collect()
    assert row["keep"] and row["perplexity"] == pytest.approx(1.0)
    assert quality(frame([]), labels).collect() == []
