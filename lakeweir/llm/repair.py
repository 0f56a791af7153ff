"""Token ids in files compressed by Re-Pair grammars.

Each shard holds the ids of neighbouring documents as a sequence of symbols. A
frequent pair of symbols becomes a rule and its occurrences a new symbol, again
and again; as ids form few pairs and pairs of pairs, the sequence shrinks. The
length that each rule expands to is stored with it, so that a reader finds the
symbols of any range of ids without expanding what is before them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import saved, text_slices, tidy
from lakeweir.llm.tokens import ENCODE_BYTES, encoder

#: Ids in a shard; one document of more makes a larger shard.
SHARD_IDS = 400_000
#: A pair is replaced while it occurs so often, and rounds go on while each takes away such a part of the sequence.
LEAST_COUNT = 4
LEAST_GAIN = 0.02
_TABLE = 1 << 20


@dataclass
class Grammar:
    """``symbols`` over ids below ``base`` and rules from ``base`` on; ``lengths`` are the rules' expansions."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        while True:
            made = symbols >= self.base
            if not made.any():
                return symbols
            at = np.cumsum(made + 1) - made - 1
            out = np.empty(len(symbols) + int(made.sum()), np.uint32)
            rule = symbols[made] - self.base
            out[at[~made]] = symbols[~made]
            out[at[made]] = self.left[rule]
            out[at[made] + 1] = self.right[rule]
            symbols = out

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` up to ``last``, by the lengths of the symbols before them."""
        made = self.symbols >= self.base
        sizes = np.ones(len(self.symbols), np.int64)
        sizes[made] = self.lengths[self.symbols[made] - self.base]
        ends = np.cumsum(sizes)
        a = int(np.searchsorted(ends, first, side="right"))
        b = int(np.searchsorted(ends, last, side="left")) + 1
        skipped = first - (int(ends[a - 1]) if a else 0)
        return self.expand(self.symbols[a:b])[skipped : skipped + last - first]


def _frequent_pairs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that occur at least :data:`LEAST_COUNT` times, most frequent first."""
    # Symbols by their rank among those in use; up to 2^16 of them, a pair fits 32 bits.
    used = np.zeros(int(seq.max()) + 1, bool)
    used[seq] = True
    symbols = np.flatnonzero(used).astype(np.uint32)
    kind, shift = (np.uint32, 16) if len(symbols) <= 1 << 16 else (np.uint64, 32)
    rank = (np.cumsum(used) - 1).astype(kind)[seq]
    keys = np.sort((rank[:-1] << kind(shift)) | rank[1:])
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(starts, append=len(keys))
    often = counts >= LEAST_COUNT
    pairs, counts = keys[starts[often]], counts[often]
    pairs = pairs[np.argsort(-counts, kind="stable")]
    return symbols[pairs >> kind(shift)], symbols[pairs & kind((1 << shift) - 1)]


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))
    return (h ^ (h >> np.uint32(15))) & np.uint32(_TABLE - 1)


def compress(ids: np.ndarray) -> Grammar:
    """A Re-Pair grammar of a sequence.

    A round replaces all frequent pairs at once; where two of them overlap, the
    more frequent one stands, and the other waits for the next round.
    """
    base = int(ids.max(initial=0)) + 1
    seq, lefts, rights = ids.astype(np.uint32), [], []
    next_symbol = base
    while len(seq) > 1:
        a, b = _frequent_pairs(seq)
        if not len(a):
            break
        # Of pairs with one slot in the table, the most frequent is taken in this round.
        slot = _slot(a, b)
        first = np.unique(slot, return_index=True)[1]
        first.sort()
        a, b, slot = a[first], b[first], slot[first]
        table = np.full(_TABLE, -1, np.int32)
        table[slot] = np.arange(len(a), dtype=np.int32)
        rank = table[_slot(seq[:-1], seq[1:])]
        at = np.flatnonzero(rank >= 0)
        rank = rank[at]
        same = (seq[at] == a[rank]) & (seq[at + 1] == b[rank])
        at, rank = at[same], rank[same]
        chosen, chosen_rank = [], []
        while len(at):
            after = np.diff(at, append=at[-1] + 2) == 1
            before = np.concatenate(([False], after[:-1]))
            # Equal neighbours, as in a run of one id, go to the first of them.
            worse = (before & (np.concatenate(([0], rank[:-1])) <= rank)) | (after & (np.concatenate((rank[1:], [0])) < rank))
            won = ~worse
            chosen.append(at[won])
            chosen_rank.append(rank[won])
            beside = (before & np.concatenate(([False], won[:-1]))) | (after & np.concatenate((won[1:], [False])))
            left = worse & ~beside
            at, rank = at[left], rank[left]
        at, rank = np.concatenate(chosen), np.concatenate(chosen_rank)
        used = np.flatnonzero(np.bincount(rank))
        number = np.zeros(len(a), np.uint32)
        number[used] = np.arange(len(used), dtype=np.uint32)
        seq = seq.copy()
        seq[at] = next_symbol + number[rank]
        gone = np.zeros(len(seq), bool)
        gone[at + 1] = True
        shrunk = len(at) / len(seq)
        seq = seq[~gone]
        lefts.append(a[used])
        rights.append(b[used])
        next_symbol += len(used)
        if shrunk < LEAST_GAIN:
            break
    left = np.concatenate(lefts) if lefts else np.zeros(0, np.uint32)
    right = np.concatenate(rights) if rights else np.zeros(0, np.uint32)
    lengths, start = np.ones(next_symbol, np.uint32), base
    for part in lefts:  # a round's rules use symbols of the rounds before
        end = start + len(part)
        lengths[start:end] = lengths[left[start - base : end - base]] + lengths[right[start - base : end - base]]
        start = end
    return Grammar(base, left, right, lengths[base:], seq)


def planes(values: np.ndarray) -> bytes:
    """32-bit values as four planes of bytes, which the file's compression packs better."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


_SHARD = (
    "part int, shard int, before_in_part long, n_docs long, n_ids long, base long, doc_ids array<{id}>, doc_lengths binary, "
    "rules_left binary, rules_right binary, rule_lengths binary, symbols binary"
)


class TokenFiles:
    """A folder of Parquet files with a row per shard; shards follow one another in ``(part, shard)`` order."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def write(cls, docs: DataFrame, path: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
        """Encode all texts and write them in ascending order of id.

        Null ids come last; texts of one id are ordered by a hash, and equal
        rows each keep theirs. A null or empty text has the end id alone. An
        empty table gives an empty folder of files.
        """
        kind = docs.schema[id_col].dataType.simpleString()
        names = [part.split()[0] for part in _SHARD.split(", ")]

        def row(number: int, before: int, ids: list[pa.Array], tokens: list[np.ndarray], lengths: list[np.ndarray]):
            grammar, length = compress(np.concatenate(tokens)), np.concatenate(lengths)
            docs_of = pa.concat_arrays(ids)
            one = [before, len(length), int(length.sum()), grammar.base]
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()), *(pa.array([n], pa.int64()) for n in one),
                 pa.ListArray.from_arrays(pa.array([0, len(docs_of)], pa.int32()), docs_of),
                 *(pa.array([planes(v)], pa.binary()) for v in (length, grammar.left, grammar.right, grammar.lengths, grammar.symbols))],
                names=names,
            )

        def work(batches):
            made, before, ids, tokens, lengths, held = 0, 0, [], [], [], 0
            with encoder(tokenizer) as known:
                for part in (part for batch in batches for part in text_slices(batch, "text", ENCODE_BYTES)):
                    out, starts = known.encode(part.column("text"), end)
                    first = 0
                    while first < part.num_rows:
                        # As many documents as the shard has room for, and one at least.
                        room = starts[first] + SHARD_IDS - held
                        last = max(first + 1, int(np.searchsorted(starts, room, side="right")) - 1)
                        ids.append(part.column("doc_id").slice(first, last - first))
                        tokens.append(out[starts[first] : starts[last]])
                        lengths.append(np.diff(starts[first : last + 1]))
                        held, first = held + len(tokens[-1]), last
                        if held >= SHARD_IDS or first < part.num_rows:
                            yield row(made, before, ids, tokens, lengths)
                            made, before, ids, tokens, lengths, held = made + 1, before + held, [], [], [], 0
            if ids:
                yield row(made, before, ids, tokens, lengths)

        texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
        sorted_texts = texts.repartitionByRange(order[0]).sortWithinPartitions(*order)
        sorted_texts.mapInArrow(tidy(work), _SHARD.format(id=kind)).write.option("compression", "zstd").parquet(path)
        return cls(docs.sparkSession, path)

    def shards(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def placed(self) -> DataFrame:
        """All shards with ``before``, the ids of all shards before each.

        Each part's size is one row. They are written, so Spark knows their size and, where that
        is small enough, moves no shard.
        """
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = self.shards().groupBy("part").agg(F.sum("n_ids").alias("ids"))
        parts = parts.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("earlier"))
        return self.shards().join(saved(parts, "parts"), "part").withColumn("before", F.col("before_in_part") + F.col("earlier")).drop("earlier")

    def documents(self) -> DataFrame:
        """``(doc_id, start, n_tokens, ids)`` of every document, decoded from its shard.

        ``start`` counts the ids of all documents before it; ``ids`` holds them
        as little-endian unsigned integers of 32 bits.
        """
        shards = self.placed()
        kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

        def work(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = {name: batch.column(name)[i] for name in batch.schema.names}
                    blobs = {k: from_planes(shard[k].as_py()) for k in ("doc_lengths", "rules_left", "rules_right", "rule_lengths", "symbols")}
                    grammar = Grammar(shard["base"].as_py(), *(blobs[k] for k in ("rules_left", "rules_right", "rule_lengths", "symbols")))
                    ids = grammar.expand(grammar.symbols).astype("<u4")
                    lengths = blobs["doc_lengths"].astype(np.int64)
                    starts = np.concatenate(([0], np.cumsum(lengths)))
                    doc_ids = shard["doc_ids"].values
                    blob = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer((starts * 4).astype(np.int32)), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids, pa.array(starts[:-1] + shard["before"].as_py()), pa.array(lengths), blob], names=["doc_id", "start", "n_tokens", "ids"]
                    )

        return shards.mapInArrow(tidy(work), f"doc_id {kind}, start long, n_tokens long, ids binary")

    def slices(self, wanted: DataFrame) -> DataFrame:
        """``(first, last, ids)`` for ranges of positions in the whole sequence of ids.

        A range is cut where shards end, so it can give several rows, each with
        its own ``first`` and ``last``. Only the symbols of a range are expanded.
        """
        shards = self.placed().withColumn("cell", F.explode(F.sequence(F.expr(f"before div {SHARD_IDS}"), F.expr(f"(before + n_ids - 1) div {SHARD_IDS}"))))
        ranges = wanted.select("first", "last").where("first < last").withColumn("cell", F.explode(F.sequence(F.expr(f"first div {SHARD_IDS}"), F.expr(f"(last - 1) div {SHARD_IDS}"))))
        meet = ranges.join(shards, "cell").where("first < before + n_ids AND last > before")
        meet = meet.withColumns({"first": F.greatest("first", "before"), "last": F.least("last", F.col("before") + F.col("n_ids"))}).dropDuplicates(["first", "last"])

        def work(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    parts = (from_planes(row[k]) for k in ("rules_left", "rules_right", "rule_lengths", "symbols"))
                    ids = Grammar(row["base"], *parts).ids(row["first"] - row["before"], row["last"] - row["before"])
                    yield pa.RecordBatch.from_pylist([{"first": row["first"], "last": row["last"], "ids": ids.astype("<u4").tobytes()}])

        columns = ["first", "last", "before", "base", "rules_left", "rules_right", "rule_lengths", "symbols"]
        return meet.select(columns).mapInArrow(work, "first long, last long, ids binary")


def token_files(docs: DataFrame, folder: str, tokenizer: str, end: int) -> TokenFiles:
    """Write a new folder of files below ``folder``."""
    return TokenFiles.write(docs, f"{folder}/token-files-{uuid.uuid4().hex}", tokenizer, end)
