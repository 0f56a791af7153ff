"""Runs of repeating words, against all stretches of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakeweir.llm.runs import Texts, find_runs, with_planted_runs, with_runs


def brute(words, least=12):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, 2 * q):
                best.setdefault((start, length), q)
    return sorted((s, length, q) for (s, length), q in best.items())


def dropped(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts_of_all_kinds():
    rng = random.Random(3)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 500, list("ab" * 40 + "a" + "ab" * 40), fibonacci(400)]
    out.append([str(bin(i).count("1") % 2) for i in range(600)])  # squares, but no three periods in a row
    for _ in range(150):
        out.append([rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 160))])
    for _ in range(150):  # nested repetitions, broken here and there
        w = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        for _ in range(rng.randint(1, 4)):
            w = (w * rng.randint(1, 5))[:300]
            if rng.random() < 0.6:
                w = [rng.choice("ab") for _ in range(rng.randint(0, 3))] + w
            if w and rng.random() < 0.5:
                w[rng.randrange(len(w))] = rng.choice("abcd")
        out.append(w[:350])
    return out


@pytest.mark.parametrize("least", [12, 7, 4, 2])
def test_same_runs_as_brute_force(least):
    docs = texts_of_all_kinds()
    texts = Texts.of(pa.array([" ".join(d) for d in docs]))
    assert np.diff(texts.starts).tolist() == [len(d) for d in docs]
    start, length, period = find_runs(texts.codes, texts.starts, least)
    doc = np.searchsorted(texts.starts, start, side="right") - 1
    found = [[] for _ in docs]
    for d, s, n, q in zip(doc, start - texts.starts[doc], length, period, strict=True):
        found[d].append((int(s), int(n), int(q)))
    for d, words in enumerate(docs):
        assert found[d] == brute(words, least), words


def test_long_repetition_stays_cheap():
    # Half a million equal words, and two stretches of one period that meet out of step.
    words = ["x"] * 500_000 + ["a", "b"] * 20_000 + ["b"] + ["a", "b"] * 20_000
    texts = Texts.of(pa.array([" ".join(words)]))
    start, length, period = find_runs(texts.codes, texts.starts)
    assert (0, 500_000, 1) in set(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
    found = brute(words)
    return len(words), found, " ".join(dropped(words, found))


def test_planted_and_awkward_texts(spark, frame, awkward):
    rng = random.Random(8)
    rows = [(i, " \n".join(rng.choice("ein zwei drei é 😀 x\x01".split()) for _ in range(rng.randint(0, 120))), "en", "a") for i in range(120)]
    docs = frame(rows).unionByName(awkward.where("doc_id IS NULL OR doc_id <> 5"))
    got = with_runs(with_planted_runs(docs)).collect()
    want = sorted((str(r["doc_id"]), *expected(r["doc_id"], r["text"])) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == want
    assert any(r["runs"] for r in got)


def test_empty_table_and_long_text(spark, frame, awkward):
    assert with_runs(with_planted_runs(frame([]))).collect() == []
    (row,) = with_runs(awkward.where("doc_id = 5")).collect()
    assert row["n_words"] == 120_000 and not row["runs"]


def test_query_digests(spark):
    from __spark_entry__ import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in queries()["op13_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) == len(docs)
    for d in docs:
        if len((d["text"] or "").split()) > 1500:
            continue
        _, found, text = expected(d["doc_id"], d["text"])
        r = rows[d["doc_id"]]
        assert r["n_runs"] == len(found)
        longest = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == longest
        assert r["exponent_milli"] == (1000 * longest[1] // longest[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(text.encode()).hexdigest()
