"""The queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.llm.common import prepared, read_table, shared_folder
from lakeweir.llm.html import main_texts
from lakeweir.llm.kneserney import quality
from lakeweir.llm.langid import identified
from lakeweir.llm.lengths import length_counts, length_histogram
from lakeweir.llm.mixing import mixed
from lakeweir.llm.packing import packed
from lakeweir.llm.partenum import similar_components
from lakeweir.llm.postings import contamination
from lakeweir.llm.repair import token_files
from lakeweir.llm.runs import with_planted_runs, with_runs
from lakeweir.llm.shallot import clustered, integer_vectors
from lakeweir.llm.spotjoin import similar_spots
from lakeweir.llm.spotsigs import edited_fingerprints
from lakeweir.llm.sql import CLUSTERS, DECONTAMINATION, NGRAM_JACCARD, RUNS
from lakeweir.llm.surrogates import with_surrogates
from lakeweir.llm.tokens import tokenizer_source

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1

#: The key that surrogates are drawn with here; a production run brings its own.
SURROGATE_KEY = "documents"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogates(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(read_table(spark, sf_dir, "documents"))


def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(length_counts(read_table(spark, sf_dir, "documents"), tokenizer_source(WORD_BPE)))


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def spotsigs_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_spots(read_table(spark, sf_dir, "documents"))


def op6_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = token_files(docs, shared_folder(spark), tokenizer_source(WORD_BPE), END_ID)
    return files.documents().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read_table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(read_table(spark, sf_dir, "documents"))


def op11_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(read_table(spark, sf_dir, "documents"), tokenizer_source(BYTE_BPE), END_ID, longest=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(integer_vectors(read_table(spark, sf_dir, "embeddings"), 64, 256), 64, k=40, rounds=5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    by_length = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("longest", F.array_max(by_length))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_pii_surrogates": (op1_pii_surrogates, None),
    "op2_kneser_ney": (op2_kneser_ney, None),
    "op3_ngram_jaccard": (op3_ngram_jaccard, NGRAM_JACCARD),
    "op4_length_histogram": (op4_length_histogram, None),
    "op5_spotsigs": (op5_spotsigs, None),
    "spotsigs_join": (spotsigs_join, None),
    "op6_repair_tokens": (op6_repair_tokens, None),
    "op7_pivotal_mixing": (op7_pivotal_mixing, None),
    "op8_html_main_text": (op8_html_main_text, None),
    "op9_decontamination": (op9_decontamination, DECONTAMINATION),
    "op10_language_id": (op10_language_id, None),
    "op11_binary_packing": (op11_binary_packing, None),
    "op12_shallot_clusters": (op12_shallot_clusters, CLUSTERS),
    "op13_periodic_runs": (op13_periodic_runs, RUNS),
}

ENTRIES = {name: (prepared(query), sql) for name, (query, sql) in QUERIES.items()}
