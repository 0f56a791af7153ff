"""Exact histogram of token counts, and what its suffix sums answer.

With documents counted by encoded length, the documents and ids at or above any
length give every total that depends on a context limit: nothing else of the
corpus is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import saved, text_slices
from lakeweir.llm.tokens import ENCODE_BYTES, encoder

#: Lengths that share a block; sums go over blocks first and then inside each.
BLOCK = 1024


def length_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``(n_tokens, n_docs)``: how many documents have each encoded length.

    Every text is encoded whole. Null and empty texts have length 0. Each task
    adds up its own lengths first, so that little is shuffled.
    """

    def work(batches):
        seen: dict[int, int] = {}
        with encoder(tokenizer) as tokens:
            for part in (part for batch in batches for part in text_slices(batch, "text", ENCODE_BYTES)):
                _, starts = tokens.encode(part.column("text"))
                for n, times in zip(*(a.tolist() for a in np.unique(np.diff(starts), return_counts=True)), strict=True):
                    seen[n] = seen.get(n, 0) + times
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], names=["n_tokens", "n_docs"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(work, "n_tokens long, n_docs long")
    # Written once: sums over lengths read it several times.
    return saved(counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "lengths")


def length_histogram(counts: DataFrame) -> DataFrame:
    """Suffix sums over ``(n_tokens, n_docs)`` rows of distinct lengths.

    Returns a row per length: ``docs_at_least`` and ``tokens_at_least`` count the
    documents of at least this length and their ids, ``truncated_tokens`` is the
    sum of all ids if each document were cut to this length, ``docs_share`` the
    part of the documents that is no longer. An empty frame gives no rows.
    """
    rows = counts.withColumns({"block": F.expr(f"n_tokens div {BLOCK}"), "tokens": F.col("n_tokens") * F.col("n_docs")})
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    # As many rows as the longest document has thousands of ids.
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("b_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("b_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("b_docs").over(everything).alias("all_docs"),
        F.sum("b_tokens").over(everything).alias("all_tokens"),
    )
    own = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"docs_own": F.sum("n_docs").over(own), "tokens_own": F.sum("tokens").over(own)}).join(blocks, "block")
    docs, tokens = F.col("docs_own") + F.col("docs_above"), F.col("tokens_own") + F.col("tokens_above")
    return rows.select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("all_tokens") - tokens + F.col("n_tokens") * docs).alias("truncated_tokens"),
        ((F.col("all_docs") - docs + F.col("n_docs")) / F.col("all_docs")).alias("docs_share"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``(context, docs_over, tokens_kept)`` for context limits: documents cut, and ids left.

    ``limits`` is a list that the caller states; each row of the histogram is
    read once for all of them.
    """
    sums = []
    for i, limit in enumerate(limits):
        sums += [
            F.coalesce(F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs"))), F.lit(0)).alias(f"d{i}"),
            F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias(f"t{i}"),
        ]
    rows = [F.struct(F.lit(limit).cast("long").alias("context"), F.col(f"d{i}").alias("docs_over"), F.col(f"t{i}").alias("tokens_kept")) for i, limit in enumerate(limits)]
    return histogram.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the least length that such a part of the documents does not exceed."""
    found = [F.min(F.when(F.col("docs_share") >= s, F.col("n_tokens"))).alias(f"q{i}") for i, s in enumerate(shares)]
    rows = [F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)]
    return histogram.agg(*found).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
