"""A training-data pipeline over ``documents``, as stages that each rewrite the table.

Each stage takes the table that the one before has left, and all but the last
return its columns. A row is a document; stages cope with null and repeated ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.functions.columns import comparable, quoted
from lakeweir.llm.common import prepared, read_table, saved, shared_folder
from lakeweir.llm.langid import held_out, train, with_language
from lakeweir.llm.mixing import mixed
from lakeweir.llm.partenum import similar_components
from lakeweir.llm.postings import contamination
from lakeweir.llm.queries import END_ID, WORD_BPE
from lakeweir.llm.repair import token_files
from lakeweir.llm.tokens import tokenizer_source
from lakeweir.operators.dedupe import drop_duplicate_rows

#: Documents with this share of their runs of so many words in common, in percent, are near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80


#: Copies of one row that a task makes at a time.
COPIES_AT_ONCE = 1000


def _row_key(docs: DataFrame):
    """A hash of all columns, whatever their names and types; maps count as sorted entries."""
    return F.xxhash64(*[comparable(quoted(f.name), f.dataType) for f in docs.schema.fields])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, and texts that do not fit the language they are most like, go."""
    code, score, fits = "__lang_pred", "__lang_score", "__lang_fits"
    model = train(docs.select("doc_id", "text", "lang"), ~held_out())
    # Python tasks take columns by names without dots.
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    known = with_language(docs.toDF(*names), model, code, score, fits)
    return known.where(F.col(fits)).drop(code, score, fits).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each component the row with the smallest id stays.

    Rows are told apart by all of their columns, so rows of one id and different
    texts are different rows. Null ids come last, rows of one id go by their key,
    and equal rows leave one. Rows without words are in no group and stay.
    """
    key = _row_key(docs)
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", key.alias("key"))
    rows = similar_components(docs.select(row.alias("row"), "text"), "row", n=NEAR_WORDS, percent=NEAR_PERCENT).where("n_shingles > 0")
    rows = saved(rows.select(F.col("doc_id.key").alias("own"), F.col("component_id.key").alias("first")), "kept")
    gone = rows.where("own <> first").select(F.col("own").alias("__gone")).distinct()
    twice = rows.where("own = first").groupBy("own").count().where("count > 1").select(F.col("own").alias("__twice"))
    kept = docs.join(gone, key == gone["__gone"], "left_anti")
    marked = kept.join(twice, key == twice["__twice"], "left")
    once = marked.where("__twice IS NULL").drop("__twice")
    return once.unionByName(drop_duplicate_rows(marked.where("__twice IS NOT NULL").drop("__twice")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with ten consecutive words of an item go."""
    rows = contamination(docs.select(_row_key(docs).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    gone = rows.where("contaminated").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, _row_key(docs) == gone["__gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each row is repeated as often as the mix takes it, or goes.

    Equal rows share the copies that they take together.
    """
    keyed = docs.withColumn("__key", _row_key(docs))
    taken = mixed(keyed.select("doc_id", "source", "text", "__key"), keep=["__key"])
    taken = taken.groupBy("__key").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    taken = taken.where("__copies > 0").withColumnRenamed("__key", "__of")
    joined = keyed.join(taken, keyed["__key"] == taken["__of"])
    alone = joined.where("__rows = 1").withColumn("__copy", F.explode(F.expr("sequence(1, cast(__copies AS INT))")))
    # Equal rows are one row with all of their copies, made in portions that tasks can share.
    portion = F.explode(F.expr(f"sequence(0L, (__copies - 1) div {COPIES_AT_ONCE})")).alias("__portion")
    many = taken.where("__rows > 1").select("__of", "__copies", portion)
    own = F.expr(f"least(__copies - __portion * {COPIES_AT_ONCE}, {COPIES_AT_ONCE})").cast("int")
    one = drop_duplicate_rows(joined.where("__rows > 1").select(*[quoted(c) for c in docs.columns], "__key"), "__key")
    many = one.join(many, one["__key"] == many["__of"]).withColumn("__copy", F.explode(F.sequence(F.lit(1), own)))
    columns = [quoted(c) for c in docs.columns]
    return alone.select(*columns).unionByName(many.select(*columns))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output: Re-Pair files of all documents, and what is read back from them."""
    files = token_files(docs, shared_folder(spark), tokenizer_source(WORD_BPE), END_ID)
    return files.documents().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language_id", prepared(identify_language)),
    ("ngram_jaccard_join", prepared(one_of_each_group)),
    ("benchmark_decontamination", prepared(drop_contaminated)),
    ("mixing", prepared(mix_sources)),
    ("token_output", prepared(write_tokens)),
]

#: The tokenizer and the fitted classifier have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
