"""Packing by powers of two: sequences of equal lengths, and none that crosses documents.

A document of ``n`` ids is cut into as many pieces of the longest length as it
has room for, and then one piece for each binary digit of what is left, the
longest first. Every piece is a sequence of its own: no padding, no attention
across documents, and each id once. Sequences of one length share a bucket, so
a training step takes all of its sequences from one bucket and has a fixed
number of ids.

Documents are encoded where they are read. A task writes its pieces with their
places in its buckets; numbers over all tasks come from the sizes of the tasks'
buckets, at most a dozen rows a task. These are written, so Spark knows their
size: while that allows a broadcast, no text and no id is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import numbered, saved, text_slices
from lakeweir.llm.tokens import ENCODE_BYTES, encoder

#: Ids of the longest piece; a power of two.
LONGEST = 2048


def cuts(lengths: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """``(document, length)`` of all pieces of documents of these lengths, in their order."""
    top = longest.bit_length() - 1
    whole, rest = lengths >> top, lengths & (longest - 1)
    # One row a document: its whole pieces first, then its binary digits from the greatest on.
    digits = (rest[:, None] >> np.arange(top - 1, -1, -1)) & 1
    times = np.concatenate((whole[:, None], digits), axis=1).ravel()
    sizes = np.tile(longest >> np.arange(top + 1), len(lengths))
    return np.repeat(np.repeat(np.arange(len(lengths)), top + 1), times), np.repeat(sizes, times)


def packed(docs: DataFrame, tokenizer: str, end: int, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset)`` of every piece.

    ``ids`` holds the piece's ids as little-endian unsigned integers of 32 bits,
    ``start`` counts the document's ids before it and ``doc_tokens`` all of them,
    the ``end`` id included. ``bucket`` is the binary logarithm of the length;
    sequences are numbered without a gap from 0, bucket after bucket. A piece
    is a whole sequence, so ``offset`` is always 0. Null and empty texts are one
    piece of the end id. Every row is packed by itself, those of repeated and
    null ids too; further columns are left behind. An empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest length must be a power of two, not {longest}")
    top = longest.bit_length() - 1
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        made, task = np.zeros(top + 1, np.int64), TaskContext.get().partitionId()
        with encoder(tokenizer) as tokens:
            for part in (part for batch in batches for part in text_slices(batch, "text", ENCODE_BYTES)):
                ids, starts = tokens.encode(part.column("text"), end)
                doc, length = cuts(np.diff(starts), longest)
                bounds = np.concatenate(([0], np.cumsum(length)))
                bucket = np.log2(length).astype(np.int32)
                # A piece's place among those of its length, in the order of the text.
                order = np.argsort(bucket, kind="stable")
                sizes = np.bincount(bucket, minlength=top + 1)
                place = np.empty(len(bucket), np.int64)
                place[order] = np.arange(len(bucket)) - np.repeat(np.cumsum(sizes) - sizes - made, sizes)
                made += sizes
                blob = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(bounds[:-1] - starts[doc]), pa.array(length), blob, pa.array(np.diff(starts)[doc]),
                     pa.array(bucket), pa.array(np.full(len(doc), task, np.int32)), pa.array(place)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket", "task", "place"],
                )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    pieces = saved(texts.mapInArrow(work, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, bucket int, task int, place long"), "pieces")
    # A row for each task and bucket: the pieces before it.
    sizes = pieces.groupBy("bucket", "task").agg(F.count("*").alias("n"))
    within = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.groupBy("bucket").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(buckets, "bucket")
    sizes = sizes.select("bucket", "task", (F.col("before") + F.col("first")).alias("before"))
    return pieces.join(saved(sizes, "sizes"), ["bucket", "task"]).select(
        "doc_id", "start", "length", "ids", "doc_tokens", "bucket", (F.col("before") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences as Parquet with a folder for each bucket, for a reader that takes one length at a time."""
    pieces.select("sequence_id", "doc_id", "start", "ids", "bucket").write.partitionBy("bucket").parquet(path)


def steps(pieces: DataFrame, ids_per_step: int, seed: int = 0) -> DataFrame:
    """``(bucket, step, sequence_id, length)``: sequences dealt to steps of one length and ``ids_per_step`` ids each.

    A bucket's sequences are shuffled by a hash of their number and taken in that order; its
    last step may hold fewer. Steps are numbered within their bucket. Ranks
    come from ranges of the hash, so no bucket is gathered in a task.
    """
    if ids_per_step < LONGEST or ids_per_step & (ids_per_step - 1):
        raise ValueError("a step must hold a power of two of ids, the longest sequence at least")
    rows = pieces.select("bucket", "sequence_id", "length", F.xxhash64("sequence_id", F.lit(seed)).alias("draw"))
    ranked = numbered(rows, [F.col("bucket"), F.col("draw"), F.col("sequence_id")], "rank")
    first = ranked.groupBy("bucket").agg(F.min("rank").alias("first"))
    ranked = ranked.join(F.broadcast(first), "bucket")  # a row for each power of two
    return ranked.select("bucket", F.expr(f"(rank - first) div ({ids_per_step} div length)").alias("step"), "sequence_id", "length")
