"""A positional inverted index of documents, and the test items found with it.

The index is a table: a row for each term of each shard of documents, with the
positions of the term. Looking up a phrase joins its terms with that table,
starts from the positions of its rarest term, and keeps those where every other
term stands at its offset.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import each_group, saved, text_slices
from lakeweir.llm.words import NOT_ALNUM, grams, words_of

#: Words in a shard, and unused positions between its documents.
SHARD_WORDS = 1_500_000
GAP = 64

_INDEX = (
    "kind int, shard long, ordinal int, doc_id {id}, first long, n_words long, term long, n long, positions binary"
)


def _shard_rows(number: int, ids: list[pa.Array], hashes: list[np.ndarray], lengths: list[np.ndarray]):
    """The rows of one shard: its documents, and the positions of each of its terms."""
    length = np.concatenate(lengths)
    words = np.concatenate(hashes)
    first = np.concatenate(([0], np.cumsum(length + GAP)))[:-1]
    position = np.arange(len(words)) + np.repeat(np.arange(len(length)) * GAP, length)
    doc_ids = pa.concat_arrays(ids)
    n_docs = len(length)
    null = lambda n, kind: pa.nulls(n, kind)
    shard = lambda n: pa.array(np.full(n, number, np.int64))
    kind = lambda n, k: pa.array(np.full(n, k, np.int32))
    yield [
        kind(n_docs, 0), shard(n_docs), pa.array(np.arange(n_docs, dtype=np.int32)), doc_ids, pa.array(first),
        pa.array(length), null(n_docs, pa.int64()), null(n_docs, pa.int64()), null(n_docs, pa.binary()),
    ]
    order = np.argsort(words, kind="stable")
    terms, starts = np.unique(words[order], return_index=True)
    sorted_positions = position[order].astype(np.uint32)
    steps = np.diff(sorted_positions, prepend=np.uint32(0))
    steps[starts] = sorted_positions[starts]
    bounds = np.concatenate((starts, [len(words)]))
    blobs = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(steps)])
    n = len(terms)
    yield [
        kind(n, 1), shard(n), null(n, pa.int32()), null(n, doc_ids.type), null(n, pa.int64()),
        null(n, pa.int64()), pa.array(terms.view(np.int64)), pa.array(np.diff(bounds)), blobs,
    ]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of all words of all documents, and return it.

    Rows of ``kind`` 0 are documents (``shard``, ``ordinal``, ``doc_id``, their
    ``first`` position and ``n_words``), rows of ``kind`` 1 are postings
    (``shard``, ``term``, ``n``, ``positions`` as steps of 32 bits). Words are
    lower-cased runs of digits, ASCII letters and characters beyond ASCII. A
    null or empty text is a document without words.
    """
    names = [part.split()[0] for part in _INDEX.split(", ")]
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        ids, hashes, lengths, held = [], [], [], 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = words_of(part.column("text"), NOT_ALNUM)
                ids.append(part.column("doc_id"))
                hashes.append(words.hashes)
                lengths.append(np.diff(words.starts))
                held += len(words.hashes)
                if held >= SHARD_WORDS:
                    for columns in _shard_rows(base + made, ids, hashes, lengths):
                        yield pa.RecordBatch.from_arrays(columns, names=names)
                    made, ids, hashes, lengths, held = made + 1, [], [], [], 0
        if ids:
            for columns in _shard_rows(base + made, ids, hashes, lengths):
                yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return saved(texts.mapInArrow(work, _INDEX.format(id=kind)), "postings")


def item_windows(items: DataFrame, length: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(terms, items)``: each run of ``length`` words of the items once, with the ids of its items as text.

    An item with fewer words, but not none, is one run. Null ids are not listed.
    """

    def work(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = words_of(part.column("text"), NOT_ALNUM)
                ids, runs = [], []
                for i, item in enumerate(part.column("item").to_pylist()):
                    own = words.hashes[words.starts[i] : words.starts[i + 1]].view(np.int64)
                    for j in range(max(len(own) - length + 1, min(len(own), 1))):
                        ids.append(item)
                        runs.append(own[j : j + length])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(runs, pa.list_(pa.int64()))], names=["item", "terms"])

    texts = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return texts.mapInArrow(work, "item string, terms array<long>").groupBy("terms").agg(F.array_sort(F.collect_set("item")).alias("items"))


class ShardLookup:
    """The documents and postings of one shard, and the places of phrases in it."""

    def __init__(self, group: pa.Table):
        kinds = group.column("kind").to_numpy()
        docs = group.filter(pa.array(kinds == 0)).select(["first", "ordinal", "n_words"]).sort_by("first")
        self.first = docs.column("first").to_numpy()
        self.ordinal = docs.column("ordinal").to_numpy()
        self.n_words = docs.column("n_words").to_numpy()
        posted = group.filter(pa.array(kinds == 1))
        self.postings = dict(zip(posted.column("term").to_pylist(), posted.column("positions"), strict=True))
        self.queries = group.filter(pa.array(kinds == 2))
        self.decoded: dict[int, np.ndarray] = {}

    def positions(self, term: int) -> np.ndarray:
        if term not in self.decoded:
            blob = self.postings.get(term)
            steps = np.zeros(0, np.uint32) if blob is None else np.frombuffer(blob.as_py(), np.uint32)
            self.decoded[term] = np.cumsum(steps, dtype=np.int64)
        return self.decoded[term]

    def phrase(self, terms: list[int], rarest: int) -> np.ndarray:
        """Where the terms stand one after another: starts of the phrase."""
        at = self.positions(terms[rarest]) - rarest
        others = sorted((len(self.positions(t)), i) for i, t in enumerate(terms) if i != rarest)
        for n, i in others:
            if not len(at) or not n:
                return at[:0]
            there = self.positions(terms[i])
            found = np.minimum(np.searchsorted(there, at + i), n - 1)
            at = at[there[found] == at + i]
        return at

    def together(self, terms: list[int], rarest: int, within: int) -> np.ndarray:
        """Where all terms stand, in any order, inside ``within`` words: places of the rarest one."""
        at = self.positions(terms[rarest])
        others = [self.positions(t) for t in {*terms} - {terms[rarest]}]
        if any(not len(p) for p in others):
            return at[:0]
        found = np.zeros(len(at), bool)
        for back in range(within):
            low = at - back
            fits = np.ones(len(at), bool)
            for there in others:
                i = np.searchsorted(there, low)
                fits &= (i < len(there)) & (there[np.minimum(i, len(there) - 1)] < low + within)
            found |= fits
        return at[found]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, side="right") - 1


def _hits(group: pa.Table, within: int | None):
    """The hit words and items of each document of one shard that has any."""
    shard = ShardLookup(group)
    if not shard.queries.num_rows:
        return
    end = int(shard.first[-1] + shard.n_words[-1])
    edges = np.zeros(end + GAP + 1, np.int32)
    found: dict[int, set[str]] = {}
    queries = zip(*(shard.queries.column(c).to_pylist() for c in ("terms", "rarest", "items")), strict=True)
    for terms, rarest, items in queries:
        if within is None:
            at, length = shard.phrase(terms, rarest), len(terms)
        else:
            at, length = shard.together(terms, rarest, within), 1
        np.add.at(edges, at, 1)
        np.add.at(edges, at + length, -1)
        for doc in np.unique(shard.doc_of(at)).tolist():
            found.setdefault(doc, set()).update(items)
    docs = np.array(sorted(found), np.int64)
    if not len(docs):
        return
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edges) > 0)))
    n_hit = covered[shard.first[docs] + shard.n_words[docs]] - covered[shard.first[docs]]
    number = group.column("shard")[0].as_py()
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(docs), number)), pa.array(shard.ordinal[docs]), pa.array(n_hit.astype(np.int64)),
         pa.array([sorted(found[d]) for d in docs.tolist()], pa.list_(pa.string()))],
        names=["shard", "ordinal", "n_hit", "items"],
    )


def find(index: DataFrame, queries: DataFrame, within: int | None = None) -> DataFrame:
    """``(shard, ordinal, n_hit, items)`` of the documents with any of the queries.

    ``queries`` has ``terms`` (word hashes in order) and ``items`` (whom they
    belong to). Without ``within`` a query is an exact phrase, and ``n_hit``
    counts the words inside any of its places; with it, all terms must stand in
    any order inside so many words, and ``n_hit`` counts places of the rarest.
    Only postings of terms in the queries leave their files; a query goes to
    those shards that have its rarest term.
    """
    if within is not None and not 0 < within <= GAP:
        raise ValueError(f"within must be from 1 to {GAP}")
    numbered = queries.where(F.size("terms") > 0).withColumn("query", F.hash("terms")).select("query", "terms", "items")
    places = numbered.select("query", "terms", "items", F.posexplode("terms").alias("rarest", "term"))
    terms = places.select("term").distinct()
    posted = index.where("kind = 1").join(terms, "term", "left_semi")
    often = posted.groupBy("term").agg(F.sum("n").alias("often"))
    rare = (
        places.join(often, "term", "left")
        .groupBy("terms", "items")
        .agg(F.min(F.struct("often", "rarest", "term")).alias("least"), F.count("often").alias("known"))
        .where(F.col("known") == F.size("terms"))
        .select("terms", "items", "least.rarest", "least.term")
    )
    asked = rare.join(posted.select("shard", "term"), "term").select("shard", "terms", "items", "rarest")
    nothing = {c: F.lit(None) for c in ("ordinal", "first", "n_words", "term", "positions", "terms", "items", "rarest")}
    columns = ["kind", "shard", *nothing]
    rows = (
        index.where("kind = 0").withColumns({c: nothing[c] for c in ("terms", "items", "rarest")}).select(columns)
        .unionByName(posted.withColumns({c: nothing[c] for c in ("terms", "items", "rarest")}).select(columns))
        .unionByName(asked.withColumns({"kind": F.lit(2), **{c: nothing[c] for c in ("ordinal", "first", "n_words", "term", "positions")}}).select(columns))
    )
    return (
        rows.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(
            lambda batches: each_group(batches, ["shard"], lambda group: _hits(group, within)),
            "shard long, ordinal int, n_hit long, items array<string>",
        )
    )


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, within: int | None = None) -> DataFrame:
    """How much of each document stands in the benchmark.

    Returns ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``: a
    word is hit inside any occurrence of ``length`` consecutive words of an item
    (all words of a shorter item), ``n_items`` counts the items with such an
    occurrence, and the digest is of their ids, sorted as text and joined by
    commas. With ``within``, the words of a run may stand in any order inside so
    many words.

    Each row of ``docs`` gives a row; null and empty texts have no words.
    Repeated items count once by id, items without id make hits but are not
    listed. Empty tables give no rows, or no hits.
    """
    index = build_index(docs)
    hits = find(index, item_windows(benchmark, length), within)
    rows = index.where("kind = 0").select("shard", "ordinal", "doc_id", "n_words").join(hits, ["shard", "ordinal"], "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
