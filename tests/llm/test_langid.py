import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeweir.llm import langid
from lakeweir.llm.langid import identified

SOUNDS = {
    "en": "the and ing that with for was ould ight this".split(), "de": "der und sch ung die ein nicht keit ich über".split(),
    "fr": "le les eau que tion est dans ou eux être".split(), "es": "el los que ción por para mente una del ñor".split(), "xx": "zqa kvu wyj xio qqe".split(),
}


@pytest.fixture
def labelled(frame):
    rng = random.Random(4)
    codes = list(SOUNDS)
    rows = []
    for i in range(400):
        code = codes[i % len(codes)]
        text = " ".join("".join(rng.choice(SOUNDS[code]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60)))
        rows.append((i, text, code, "s"))
    return frame(rows)


def test_held_out_accuracy(labelled):
    truth = {r["doc_id"]: r["lang"] for r in labelled.collect()}
    rows = identified(labelled).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_have_no_effect(labelled):
    from lakeweir.llm.langid import held_out

    changed = labelled.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in identified(df).collect())
    assert key(labelled) == key(changed)


def test_awkward_rows(awkward, labelled):
    rows = identified(labelled.unionByName(awkward)).where("doc_id IS NULL OR doc_id IN (2, 3, 4, 6)").collect()
    none = [r for r in rows if r["lang_pred"] == "und"]
    assert {r["doc_id"] for r in none} >= {2, 3, 4, 6} - {r["doc_id"] for r in rows if r["lang_pred"] != "und"}
    assert all(r["score"] == 0 for r in none)
    assert any(r["doc_id"] is None and r["lang_pred"] != "und" for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)


def test_nothing_to_learn_from(frame):
    assert [(r["lang_pred"], r["score"]) for r in identified(frame([(1, "some text")])).collect()] == [("und", 0.0)]
    assert identified(frame([])).collect() == []


def test_many_languages_and_a_long_text_fit_in_memory(monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(1)
    languages = [f"l{i}" for i in range(76)]
    families = [list(range(i, i + 4)) for i in range(0, 76, 4)]
    pairs = [(a, b) for f in families for a in f for b in f if a < b]
    k = len(families) + len(pairs)
    model = langid.Model(
        languages, families, pairs, rng.normal(size=(langid.FEATURES, k)).astype(np.float32), np.zeros(k),
        np.full((76, langid.FEATURES), -8, np.float32), np.full(76, -100.0), np.ones(76),
    )
    texts = ["ein langer text " * 16_000, "kurz", None, "ein langer text " * 16_000]
    tracemalloc.start()
    codes, scores, _ = model.predict(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
    assert codes[0] == codes[3] and scores[0] == scores[3] and codes[2] == "und"
    # The same sums in small parts.
    feature, owner, _ = langid.hashed_grams(texts[1:3] + ["noch ein text"] * 3)
    counts = np.bincount(owner, minlength=5)
    whole = model._sums(feature, counts)
    monkeypatch.setattr(langid, "GATHERED", 5 * k)
    assert np.allclose(model._sums(feature, counts), whole) and whole[0].any() and not whole[1].any()
