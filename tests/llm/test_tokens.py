import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeweir.llm.lengths import at_limits, length_counts, length_histogram, quantiles
from lakeweir.llm.repair import TokenFiles, compress, from_planes, planes
from lakeweir.llm.tokens import Encoder, tokenizer_source

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SOURCE = tokenizer_source(WORD_BPE)
PLAIN, FRESH = Tokenizer.from_file(WORD_BPE), Encoder(SOURCE)
ODD = [
    "", None, "A", "é É é H̱x", "don't I'LL x's", "a b c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y", "ÀÉİß ΑΣ ΣΑΣ Ⅷ ½ ²",
    "你好，世界 👍🏽 x​y", "a\tb\n\nc", "###$$$ 12a34", "ſ K Å ﬁ", "́x", "ǅ ᾈ", "x" * 3000, " lead trail ",
]


def ids_of(text, end):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, *([end] if end is not None else [])]


@pytest.mark.parametrize("end", [None, 1])
def test_words_give_the_ids_of_whole_texts(end):
    encoder = Encoder(SOURCE)
    assert encoder.by_word
    for _ in range(2):  # with and without known words
        ids, starts = encoder.encode(pa.array(ODD), end)
        for i, text in enumerate(ODD):
            assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(text, end)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_text(texts):
    ids, starts = FRESH.encode(pa.array(texts, pa.string()), 1)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == ids_of(text, 1)


BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTES_SOURCE, BYTES_PLAIN = tokenizer_source(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
SPACED = [*ODD, "a  b c", "\u00a0  b \u3000 \u2003x é\u00a0 y", "a \n\n  b\t c", "x,y z., ;: 12.5!? 'tis I'll", "<|endoftext|> a <|endoftext|>b,<|endoftext|>", "\u0301 , \u0301 ..., …."]


@pytest.mark.parametrize("end", [None, 1])
def test_pieces_give_the_ids_of_whole_texts(end):
    encoder = Encoder(BYTES_SOURCE)
    assert encoder.by_piece and not encoder.by_word
    for _ in range(3):
        ids, starts = encoder.encode(pa.array(SPACED), end)
        for i, text in enumerate(SPACED):
            assert ids[starts[i] : starts[i + 1]].tolist() == [*BYTES_PLAIN.encode(text or "").ids, *([end] if end is not None else [])]


KNOWN = [(Encoder(BYTES_SOURCE), BYTES_PLAIN), (Encoder(SOURCE), PLAIN)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n,.'sé1aB\u00a0\u2003"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_any_text_in_pieces_and_words(texts):
    for encoder, plain in KNOWN:
        encoder.forget()
        ids, starts = encoder.encode(pa.array(texts, pa.string()), 1)
        for i, text in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_other_tokenizers_get_whole_texts():
    spec = json.loads(BYTES_SOURCE)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    encoder, plain = Encoder(json.dumps(spec)), Tokenizer.from_str(json.dumps(spec))
    ids, starts = encoder.encode(pa.array(["a  b c", None, " x"]), 7)
    assert not encoder.by_word and not encoder.by_piece
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [[*plain.encode(t).ids, 7] for t in ("a  b c", "", " x")]


@pytest.mark.parametrize("known", KNOWN, ids=["pieces", "words"])
def test_words_in_one_call_are_merged_as_the_model_does(known):
    encoder, plain = known
    rng = np.random.default_rng(4)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "is", "x", "q", "Z", "é", "ß"]
    words = sorted({" " * encoder.by_piece + "".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(20_000)})
    assert encoder.bulk is not None and sum(map(encoder._is_plain, words)) > len(words) / 4
    for word, ids in zip(words, encoder.encoded(words), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(word, add_special_tokens=False).ids


def test_memory_of_units_is_bounded(monkeypatch):
    monkeypatch.setattr("lakeweir.llm.tokens.KEPT_UNITS", 50)
    encoder = Encoder(SOURCE)
    for i in range(30):
        texts = [" ".join(f"w{j}x" for j in range(i * 20, i * 20 + 60))]
        ids, _ = encoder.encode(pa.array(texts), 1)
        assert ids.tolist() == ids_of(texts[0], 1)
        assert len(encoder.kept) <= 50 + 60 and len(encoder.new) <= 60 * 3
    encoder.forget()
    assert not encoder.kept and not encoder.older and not encoder.new


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_grammar_round_trip(ids, a, b):
    ids = np.array(ids, np.uint32)
    grammar = compress(ids)
    assert grammar.expand(grammar.symbols).tolist() == ids.tolist()
    assert from_planes(planes(grammar.symbols)).tolist() == grammar.symbols.tolist()
    first, last = sorted((min(a, len(ids)), min(b, len(ids))))
    if first < last:
        assert grammar.ids(first, last).tolist() == ids[first:last].tolist()


def test_repeats_shrink():
    grammar = compress(np.tile(np.arange(50, dtype=np.uint32), 100))
    assert len(grammar.symbols) < 500 and len(grammar.left) < 200


def test_files_give_back_all_ids(awkward, spark, tmp_path, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.repair.SHARD_IDS", 50)
    files = TokenFiles.write(awkward, str(tmp_path / "files"), SOURCE, 1)
    rows = sorted(files.documents().collect(), key=lambda r: r["start"])
    texts = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [(r["doc_id"] is None, r["doc_id"] or 0) for r in rows]
    at, everything = 0, []
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
        everything += np.frombuffer(r["ids"], "<u4").tolist()
    key = lambda x: (str(x[0]), x[1])
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(((r["doc_id"], zlib.crc32(r["ids"])) for r in rows), key=key) == sorted(((d, crc(ids_of(t, 1))) for d, t in texts), key=key)
    wanted = spark.createDataFrame([(0, 3), (40, 200), (at - 5, at)], "first long, last long")
    for r in files.slices(wanted).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == everything[r["first"] : r["last"]]


def test_no_documents(frame, tmp_path):
    assert TokenFiles.write(frame([]), str(tmp_path / "files"), SOURCE, 1).documents().collect() == []
    assert length_histogram(length_counts(frame([]), SOURCE)).collect() == []


def test_histogram(awkward, monkeypatch):
    monkeypatch.setattr("lakeweir.llm.lengths.BLOCK", 8)
    lengths = sorted(len(ids_of(r["text"], None)) for r in awkward.collect())
    histogram = length_histogram(length_counts(awkward, SOURCE)).cache()
    rows = {r["n_tokens"]: r for r in histogram.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for n, r in rows.items():
        over = [x for x in lengths if x >= n]
        assert (r["n_docs"], r["docs_at_least"], r["tokens_at_least"]) == (lengths.count(n), len(over), sum(over))
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
        assert r["docs_share"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for r in at_limits(histogram, [0, 5, 10, 10**6]).collect():
        c = r["context"]
        assert (r["docs_over"], r["tokens_kept"]) == (sum(x > c for x in lengths), sum(min(x, c) for x in lengths))
    for r in quantiles(histogram, [0.1, 0.5, 1.0]).collect():
        assert r["n_tokens"] == next(x for x in lengths if sum(y <= x for y in lengths) >= r["share"] * len(lengths))
