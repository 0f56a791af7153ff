import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lakeweir.llm.common import saved
from lakeweir.llm.spotsigs import ANCHORS, edited_fingerprints, with_next

WORDS = {w for words in ANCHORS.values() for w in words.split()}


def signs(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    found = set()
    for i, word in enumerate(words):
        content = [w for w in words[i + 1 :] if w not in WORDS][:2] if word in WORDS else []
        if len(content) == 2:
            found.add((word, *content))
    if not found and words:
        return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return found or ({text} if text else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(df):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        same = [r for r in got if r["doc_id"] == doc and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(text)]
        assert same, (doc, text[:40])
        a, b, c = signs(text), signs(edited), signs(after)
        assert len(same[0]["fingerprint"]) == 16 * len(a) and len(same[0]["edited_fingerprint"]) == 16 * len(b)
        assert same[0]["near_edited"] == pytest.approx(likeness(a, b)) and same[0]["near_next"] == pytest.approx(likeness(a, c))


@pytest.mark.parametrize("run", [1, 3, 1000])
def test_each_with_the_next(frame, monkeypatch, run):
    monkeypatch.setattr("lakeweir.llm.spotsigs.RUN_IDS", run)
    texts = ["The house of the old man was big and the garden too", "das Haus und der Garten sind schön", "no", "", "### $$$", "zwölf Boxkämpfer jagen Viktor quer",
             "le chat est sur la table et il dort", "The house of the old man was big and the garden too", "é", None]
    check(frame([(i * i * 7 - 20, t) for i, t in enumerate(texts)]))


@pytest.mark.parametrize("cells", [1, 2, 1000])
def test_far_ids(frame, monkeypatch, cells):
    monkeypatch.setattr("lakeweir.llm.spotsigs.RUN_IDS", 2)
    monkeypatch.setattr("lakeweir.llm.spotsigs.MOST_CELLS", cells)
    check(frame([(i, f"the text number{i} of the corpus part{i} " * (1 + i % 3)) for i in (-(10**17), *range(9), 10**17)]))


def test_far_ids_share_no_cell(frame, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.spotsigs.RUN_IDS", 10)
    monkeypatch.setattr("lakeweir.llm.spotsigs.saved", lambda df, name: kept.setdefault(name, saved(df, name)))
    kept = {}
    seated = with_next(frame([(i, "a text") for i in (*range(300), 10**17)]))
    assert kept["runs"].count() == 31 and seated.where("NOT guest").count() == 301
    assert max(r["n"] for r in seated.groupBy("run").agg(F.count("*").alias("n")).collect()) <= 11


def test_ids_of_text(spark, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.spotsigs.RUN_IDS", 2)
    texts = {"a": "the cat sat", "b": "the dog ran off", "c'x": "a house of the old man", "é": "one two", None: "no id"}
    got = {r["doc_id"]: r for r in edited_fingerprints(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()}
    order = ["é", "c'x", "b", "a", None]
    for doc, after in zip(order, order[1:] + order[:1], strict=True):
        text, half = texts[doc], len(texts[doc]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_one_document_is_its_own_next(frame):
    (row,) = edited_fingerprints(frame([(5, "the cat sat on the mat today")])).collect()
    assert row["near_next"] == 1.0


def test_awkward_rows(awkward):
    got = edited_fingerprints(awkward).collect()
    assert len(got) == awkward.count()
    ones = [r for r in got if r["doc_id"] == 1]
    assert ones[0]["fingerprint"] == ones[1]["fingerprint"] != "" and max(r["near_next"] for r in ones) == 1.0
    assert all(r["n_chars"] == 0 and r["fingerprint"] == "" for r in got if r["doc_id"] in (2, 3))


def test_long_runs_of_anchors(frame):
    texts = ["the " * 30_000 + "old house stood", "of the " * 3_000 + "old house stood", "the old house stood"]
    got = {r["doc_id"]: r for r in edited_fingerprints(frame(list(enumerate(texts)))).collect()}
    assert got[0]["fingerprint"] == got[2]["fingerprint"] and len(got[1]["fingerprint"]) == 32


def test_no_rows(frame):
    assert edited_fingerprints(frame([])).collect() == []
