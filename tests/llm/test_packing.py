"""Packing, against the tokenizers library and binary numbers."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeweir.llm.packing import cuts, packed, steps, write_buckets
from lakeweir.llm.tokens import tokenizer_source

PATH = public_tokenizers.path("byte_bpe_50k.json")
SOURCE, PLAIN = tokenizer_source(PATH), Tokenizer.from_file(PATH)


def brute(text, longest):
    """``(start, length, ids)`` of a text's pieces."""
    ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]
    out, at = [], 0
    while at < len(ids):
        size = min(longest, 1 << ((len(ids) - at).bit_length() - 1))
        out.append((at, size, ids[at : at + size]))
        at += size
    return len(ids), out


@pytest.mark.parametrize("longest", [1, 2, 8, 2048])
def test_cuts_are_binary(longest):
    lengths = np.array([1, 2, 3, 7, 8, 9, 2047, 2048, 2049, 10_000])
    doc, size = cuts(lengths, longest)
    for i, n in enumerate(lengths.tolist()):
        want = [longest] * (n // longest) + [1 << b for b in range(20, -1, -1) if (n % longest) >> b & 1]
        assert size[doc == i].tolist() == want


@pytest.mark.parametrize("longest", [16, 2048])
def test_awkward_texts(awkward, longest):
    rows = packed(awkward, SOURCE, 1, longest).collect()
    got = Counter((str(r["doc_id"]), r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]) for r in rows)
    want = Counter()
    for d in awkward.collect():
        n, pieces = brute(d["text"], longest)
        want.update((str(d["doc_id"]), a, size, np.array(ids, "<u4").tobytes(), n) for a, size, ids in pieces)
    assert got == want
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    in_order = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert in_order == sorted(in_order) and {r["offset"] for r in rows} == {0}
    assert all(1 << r["bucket"] == r["length"] <= longest for r in rows)


def test_empty_table_and_bad_length(frame):
    assert packed(frame([]), SOURCE, 1).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packed(frame([]), SOURCE, 1, 1000)


def test_buckets_and_steps(spark, frame, tmp_path):
    docs = frame([(i, "word " * (i * 37 % 900), "en", "a") for i in range(60)])
    pieces = packed(docs, SOURCE, 1)
    write_buckets(pieces, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == pieces.count() and back.where("4 * power(2, bucket) <> octet_length(ids)").count() == 0
    dealt = [tuple(r) for r in steps(pieces, 2048).select("bucket", "step", "sequence_id", "length").collect()]
    assert sorted(s for _, _, s, _ in dealt) == sorted(r[0] for r in pieces.select("sequence_id").collect())
    full = Counter((b, s) for b, s, _, _ in dealt)
    for (bucket, step), n in full.items():
        last = max(s for b, s in full if b == bucket)
        assert n == 2048 >> bucket or (step == last and n < 2048 >> bucket)


def test_query_covers_every_id_once(spark):
    from __spark_entry__ import queries

    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {}
    for r in queries()["op11_binary_packing"](spark, sf_dir).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        n, pieces = brute(text, 2048)
        assert sorted(got[doc_id]) == [(a, size, zlib.crc32(np.array(ids, "<u4").tobytes()), n) for a, size, ids in pieces]
