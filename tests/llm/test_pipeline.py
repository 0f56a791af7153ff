import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(2)
    text = lambda n=40: " ".join(f"{rng.choice(['the', 'and', 'of'])} {rng.choice('abcdefgh')}{rng.randint(0, 900)}word" for _ in range(n))
    item = text(12)
    rows = [(i, text(), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100, rows[0][1], "en", "s0"), (101, rows[1][1] + " end", "en", "s1"), (102, text() + " " + item, "en", "s2"), (103, None, "en", "s3"), (104, "12 34", "en", None)]
    rows += [rows[5], (None, text(), None, None), (None, None, None, None)]
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def stage(name):
    return dict(pipeline.STAGES)[name]


def test_stages_take_effect(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    known = stage("language_id")(spark, docs, corpus)
    assert known.columns == docs.columns
    assert docs.count() - known.count() == 3 and known.where("doc_id IN (103, 104) OR text IS NULL").isEmpty()
    one = stage("ngram_jaccard_join")(spark, docs, corpus)
    counts = Counter(r["doc_id"] for r in one.collect())
    assert one.columns == docs.columns and counts[100] == counts[101] == 0 and counts[0] == counts[1] == counts[5] == 1
    assert counts[None] == 2 and counts[103] == 1 and sum(counts.values()) == docs.count() - 3
    clean = stage("benchmark_decontamination")(spark, docs, corpus)
    assert {r["doc_id"] for r in docs.exceptAll(clean).collect()} == {102}
    mixed = stage("mixing")(spark, docs, corpus)
    assert mixed.columns == docs.columns
    copies = mixed.where("source = 's2'").groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert copies <= 3 and mixed.select("text").subtract(docs.select("text")).isEmpty()
    tokens = stage("token_output")(spark, docs, corpus)
    assert tokens.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and tokens.count() == docs.count()


def test_whole_run(spark, corpus):
    rows = pipeline.run(spark, corpus).collect()
    assert rows and {r["doc_id"] for r in rows}.isdisjoint({100, 101, 102, 103, 104})
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_output"]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_between_the_limits_go(spark, corpus):
    """One with 20 % appended: 80 % of its runs of five words are the other's."""
    words = [f"word{i}" for i in range(100)]
    rows = [(1, " ".join(words[:80])), (2, " ".join(words[:98])), (3, " ".join(words[:60]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS)
    one = stage("ngram_jaccard_join")(spark, docs, corpus)
    assert {r["doc_id"] for r in one.collect()} == {1, 3}


def test_shared_and_null_ids(spark):
    text = lambda x, n=40: " ".join(f"{x}{i}" for i in range(n))
    rows = [(7, text("a")), (7, text("b")), (7, text("b")), (3, text("a")), (8, text("c")), (8, text("d")), (None, text("e")), (None, text("e")),
            (None, text("e", 41)), (None, text("c")), (None, ""), (None, ""), (9, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], COLUMNS).withColumn("n_chars", F.length("text").cast("long"))
    one = stage("ngram_jaccard_join")(spark, docs, "")
    got = Counter((r["doc_id"], (r["text"] or "")[:2]) for r in one.collect())
    assert got == {(3, "a0"): 1, (7, "b0"): 1, (8, "c0"): 1, (8, "d0"): 1, (None, "e0"): 1, (None, ""): 2, (9, ""): 2}


def test_text_of_no_learned_language_goes(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    strange = ["Быстрая лиса прыгает через ленивую собаку и бежит домой", "zqxj kvvy wwuq jjxz qyyk xzuv vvqj ykkx zuuq xxjv", "12 ψ 34 ξ ζ 5 χψ"]
    more = spark.createDataFrame([(300 + i, t, None, "s1", len(t)) for i, t in enumerate(strange)], COLUMNS)
    known = stage("language_id")(spark, docs.unionByName(more), corpus)
    assert {r["doc_id"] for r in docs.unionByName(more).exceptAll(known).collect()} == {103, 104, None, 300, 301, 302}
    assert docs.count() - known.count() == 3


def test_extra_columns_of_any_name_and_type(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    docs = docs.withColumns({"a.b": F.col("doc_id"), "m": F.create_map(F.lit("k"), F.col("text")), "__x y": F.array(F.struct(F.lit(1).alias("doc_id")))})
    docs = docs.unionAll(docs.where("doc_id = 7"))
    plain = docs.drop("a.b", "m", "__x y")
    for name, _ in pipeline.STAGES[:4]:
        out = stage(name)(spark, docs, corpus)
        assert out.columns == docs.columns, name
        if name != "mixing":
            assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, stage(name)(spark, plain, corpus).select("doc_id", "text").collect()))
        else:
            assert {r["a.b"] for r in out.collect()} <= {r["doc_id"] for r in docs.collect()}


def test_copies_of_equal_rows(spark, tmp_path, monkeypatch):
    # A source of equal rows alone: its copies come in portions and add up to its share.
    monkeypatch.setattr(pipeline, "COPIES_AT_ONCE", 7)
    rows = [(1, "same words here", "en", "a", 3)] * 50 + [(i, f"{i} other words", "en", "b", 3) for i in range(50)]
    docs = spark.createDataFrame(rows, COLUMNS)
    out = stage("mixing")(spark, docs, str(tmp_path)).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in out} == {"a": 33, "b": 67}
