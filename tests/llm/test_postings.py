import hashlib
import re

import numpy as np
import pytest

from lakeweir.llm.postings import build_index, contamination, find, item_windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, length=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - length + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + length]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        named = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def items(spark):
    rows = [
        (10, "the quick brown fox jumps over the lazy dog"), (9, "Word3 AND the ITEM3 word4 and the item4 word5 and the item5"),
        (9, "Word3 AND the ITEM3 word4 and the item4 word5 and the item5"), (11, None), (12, ""), (None, "braune Fuchs"), (13, "the"),
        (14, "no such phrase anywhere in any of the documents that are here"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_awkward_rows(awkward, items):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    assert result(contamination(awkward, items)) == brute_force(docs, asked)


def test_small_shards(awkward, items, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.postings.SHARD_WORDS", 5)
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    asked = [(r["item_id"], r["text"]) for r in items.collect()]
    assert result(contamination(awkward, items, length=3)) == brute_force(docs, asked, 3)


def test_empty_tables(frame, items):
    assert contamination(frame([]), items).collect() == []
    docs = [(1, "some words"), (2, None)]
    assert result(contamination(frame(docs), items.limit(0))) == brute_force(docs, [])


def test_proximity_finds_words_in_any_order(spark, frame):
    texts = ["alpha x beta y gamma", "gamma beta alpha", "alpha x x x x beta gamma", "alpha beta", "beta gamma", "alpha x beta", "gamma x alpha"]
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = frame(list(enumerate(texts)))
    index = build_index(docs)
    hits = find(index, item_windows(items, 3), within=5).join(index.where("kind = 0").select("shard", "ordinal", "doc_id"), ["shard", "ordinal"])
    assert sorted(r["doc_id"] for r in hits.collect()) == [0, 1]
    assert [r["doc_id"] for r in contamination(docs, items, 3).where("contaminated").collect()] == []
    with pytest.raises(ValueError):
        find(index, item_windows(items, 3), within=1000)


def test_index_has_every_word(awkward):
    index = build_index(awkward)
    posted = index.where("kind = 1").select("n", "positions").collect()
    assert sum(r["n"] for r in posted) == sum(len(words(r["text"])) for r in awkward.collect())
    assert all(len(np.frombuffer(r["positions"], np.uint32)) == r["n"] for r in posted)
