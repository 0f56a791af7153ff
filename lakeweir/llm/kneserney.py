"""Perplexity of documents under a modified Kneser-Ney model of trusted text.

The model is over characters, interpolated down to single ones. Counts live in
tables sharded by n-gram. A document's n-grams meet them in joins: texts are
dealt into chunks, each chunk's distinct n-grams are joined with the model, and
the log-probabilities come back to the chunk, where every text adds up its own.

Texts are dealt into folds, and each is scored by the model of all trusted text
outside its fold. The models share their tables: a row has one column per fold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.ipc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import saved, sifted, text_slices

#: The longest n-gram, and characters of text in a chunk.
ORDER = 4
CHUNK_CHARS = 12_000_000
#: Documents above this quantile of the trusted ones of their language are rejected.
KEEP_QUANTILE = 0.995
#: Folds of texts. A text's fold comes from its content, so copies share one.
FOLDS = 4
#: Steps of log-perplexity that quantiles are counted in.
STEPS = 2000
#: Stands before each text, so that its first character has a context.
BEFORE = "\x02"


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after its padding, and where each text starts.

    Runs of white space count as one space.
    """
    pad = BEFORE * (ORDER - 1)
    plain = [pad + " ".join(t.split()) if t else pad for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(t) for t in plain])))
    return np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32), starts


def _hashes(points: np.ndarray, n: int = ORDER) -> np.ndarray:
    """A number for each run of ``n`` code points."""
    size = max(0, len(points) - n + 1)
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = (h ^ points[i : i + size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(points, place, owner)``: where each n-gram of each text starts in the points."""
    points, starts = _points(texts)
    lengths = np.diff(starts) - (ORDER - 1)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(owner)) + owner * (ORDER - 1)
    return points, place, owner


def _fold() -> Column:
    return F.pmod(F.coalesce(F.crc32("text"), F.lit(0)), F.lit(FOLDS)).cast("int").alias("fold")


def _per_fold(column) -> list[Column]:
    """The columns of all folds, each as ``column`` makes it from the fold's number."""
    return [column(i) for i in range(FOLDS)]


class _Distinct:
    """The distinct n-grams of a task with their counts by fold, gathered slice by slice."""

    def __init__(self):
        self.hashes, self.grams, self.counts = np.zeros(0, np.uint64), np.zeros((0, ORDER), np.uint32), np.zeros((0, FOLDS), np.int64)

    def add(self, texts: list[str | None], folds: np.ndarray | None = None):
        """Take in texts; without ``folds`` n-grams are not counted."""
        points, place, owner = _grams(texts)
        if folds is None:
            h, first = np.unique(_hashes(points)[place], return_index=True)
            n = np.zeros((len(h), FOLDS), np.int64)
        else:
            h, first, of = np.unique(_hashes(points)[place], return_index=True, return_inverse=True)
            n = np.bincount(of * FOLDS + folds[owner], minlength=len(h) * FOLDS).reshape(-1, FOLDS)
        at = np.searchsorted(self.hashes, h)
        known = np.zeros(len(h), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == h[inside]
        self.counts[at[known]] += n[known]
        if not known.all():
            rows = points[place[first[~known]][:, None] + np.arange(ORDER)]
            merged = np.concatenate((self.hashes, h[~known]))
            order = np.argsort(merged)
            self.hashes, self.grams = merged[order], np.concatenate((self.grams, rows))[order]
            self.counts = np.concatenate((self.counts, n[~known]))[order]

    def strings(self) -> list[str]:
        joined = self.grams.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(gram, n0, n1, ...)``: how often each run of :data:`ORDER` characters occurs in ``text`` outside each fold.

    Tasks add up their own first. A fold that has all the text is not left out.
    """

    def work(batches):
        found = _Distinct()
        for batch in batches:
            for part in text_slices(batch, "text"):
                found.add(part.column("text").to_pylist(), part.column("fold").to_numpy())
        counts = [pa.array(np.ascontiguousarray(found.counts[:, i])) for i in range(FOLDS)]
        yield pa.RecordBatch.from_arrays([pa.array(found.strings(), pa.string()), *counts], names=["gram", *names])

    names = [f"c{i}" for i in range(FOLDS)]
    own = texts.select("text", _fold()).mapInArrow(work, "gram string, " + ", ".join(f"{c} long" for c in names))
    own = saved(own.groupBy("gram").agg(*[F.sum(c).alias(c) for c in names]), "own")
    sums = own.agg(*[F.sum(c).alias(c) for c in names]).first()
    everything = "+".join(names)
    whole = [sum(1 for c in sums if c) < 2] * FOLDS
    return own.select("gram", *_per_fold(lambda i: F.expr(everything if whole[i] else f"{everything} - c{i}").alias(f"n{i}")))


def _discounts(counts: DataFrame) -> list[list[float]]:
    """For each fold the three discounts of a table of counts, from how many counts are 1, 2, 3 and 4."""
    found = list(counts.agg(*[F.count(F.when(F.col(f"n{i}") == j, 1)) for i in range(FOLDS) for j in (1, 2, 3, 4)]).first())
    out = []
    for i in range(FOLDS):
        n1, n2, n3, n4 = found[4 * i : 4 * i + 4]
        if not (n1 and n2 and n3):  # too little text to tell: halve what a single count is worth
            out.append([0.5, 0.5, 0.5])
            continue
        y = n1 / (n1 + 2 * n2)
        out.append([min(j, max(0.05, v)) for j, v in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))])
    return out


class KneserNey:
    """Tables of interpolated models, one per fold that they leave out.

    For each order ``(gram, p0, p1, ...)`` of seen n-grams and ``(context,
    weight0, ...)`` of back-off, null where a model has not seen the context.
    """

    def __init__(self, seen: list[DataFrame], backoff: list[DataFrame], floors: list[float]):
        self.seen, self.backoff, self.floors = seen, backoff, floors

    @classmethod
    def train(cls, trusted: DataFrame) -> KneserNey:
        """Count trusted text and interpolate from single characters up.

        The longest n-grams have their counts, shorter ones the number of
        different characters seen before them. Characters never seen share the
        mass of one more.
        """
        n = lambda i: F.col(f"n{i}")
        tables = [gram_counts(trusted)]
        for _ in range(ORDER - 1):
            shorter = tables[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*_per_fold(lambda i: F.count(F.when(n(i) > 0, 1)).alias(f"n{i}")))
            tables.append(saved(shorter, "counts"))
        tables.reverse()  # by order: single characters first
        floors = [1.0 / (c + 1) for c in tables[0].agg(*_per_fold(lambda i: F.count(F.when(n(i) > 0, 1)))).first()]
        seen, backoff = [], []
        for k, counts in enumerate(tables, 1):
            d = _discounts(counts)
            context = F.expr("left(gram, char_length(gram) - 1)")
            discounts = _per_fold(lambda i, d=d: F.when(n(i) == 0, 0.0).when(n(i) == 1, d[i][0]).when(n(i) == 2, d[i][1]).otherwise(d[i][2]))
            sums = [c for i in range(FOLDS) for c in (F.sum(n(i)).alias(f"total{i}"), F.sum(discounts[i]).alias(f"mass{i}"))]
            contexts = counts.groupBy(context.alias("context")).agg(*sums)
            weights = _per_fold(lambda i: F.expr(f"CASE WHEN total{i} > 0 THEN mass{i} / total{i} END").alias(f"weight{i}"))
            contexts = saved(contexts.select("context", *_per_fold(lambda i: F.col(f"total{i}")), *weights), "contexts")
            rows = counts.withColumns({"context": context, "rest": F.expr("substring(gram, 2)")}).join(contexts, "context")
            if k > 1:
                rows = rows.join(seen[-1].select(F.col("gram").alias("rest"), *_per_fold(lambda i: F.col(f"p{i}").alias(f"lower{i}"))), "rest")
            lower = _per_fold(lambda i, k=k: F.col(f"lower{i}") if k > 1 else F.lit(floors[i]))
            p = _per_fold(
                lambda i, discounts=discounts, lower=lower: F.when(
                    F.col(f"total{i}") > 0, (n(i) - discounts[i]) / F.col(f"total{i}") + F.col(f"weight{i}") * lower[i]
                ).otherwise(lower[i]).alias(f"p{i}")
            )
            seen.append(saved(rows.select("gram", *p), "seen"))
            backoff.append(contexts.select("context", *_per_fold(lambda i: F.col(f"weight{i}"))))
        return cls(seen, backoff, floors)

    def log_probability(self, grams: DataFrame) -> DataFrame:
        """``(chunk, gram, logp)``: that of the last character of each ``gram`` given those before it.

        A chunk is of one fold, the rest of its number by :data:`FOLDS`, and takes the model that leaves it out.
        """
        own = lambda name: F.get(F.array(*_per_fold(lambda i: F.col(f"{name}{i}"))), F.col("chunk") % FOLDS)
        out = grams
        # The largest tables come first, while rows are narrow.
        for k in range(ORDER, 0, -1):
            for table, part in ((self.seen[k - 1], f"right(gram, {k})"), (self.backoff[k - 1], f"left(right(gram, {k}), {k - 1})")):
                key, *values = table.columns
                name = values[0][:-1]
                out = out.join(table.withColumnRenamed(key, "of"), F.expr(f"{part} = of"), "left").withColumn(f"{name}_{k}", own(name))
                out = out.drop("of", *values)
        p = F.get(F.array(*map(F.lit, self.floors)), F.col("chunk") % FOLDS)
        for k in range(1, ORDER + 1):
            p = F.coalesce(F.col(f"p_{k}"), F.coalesce(F.col(f"weight_{k}"), F.lit(1.0)) * p)
        return out.select("chunk", "gram", F.log(p).cast("float").alias("logp"))


def _packed(batches):
    """Rows of one chunk in a batch as one compressed block: texts take about the half of what they take by row."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        batch, chunk = batch.drop_columns(["chunk"]).take(pa.array(order)), chunk[order]
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        blocks = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch.slice(a, b - a))
            blocks.append(sink.getvalue().to_pybytes())
        if len(chunk):
            yield pa.RecordBatch.from_arrays([pa.array(chunk[cuts[:-1]]), pa.array(blocks, pa.binary())], names=["chunk", "block"])


def _unpacked(blocks: pa.Array | pa.ChunkedArray):
    """The rows of blocks, in slices of bounded text."""
    for block in blocks:
        for batch in pa.ipc.open_stream(block.as_buffer()):
            yield from text_slices(batch, "text")


def with_perplexity(docs: DataFrame, model: KneserNey) -> DataFrame:
    """``(doc_id, lang, text_hash, n_grams, log_perplexity)`` for each row; null where a text is null or blank.

    Texts move once, to their chunks, and their n-grams are extracted once;
    between chunks and model move only each chunk's distinct n-grams. A chunk
    has texts of one fold and is scored by the model that leaves it out.
    """
    named = docs.select("doc_id", "lang", "text")
    size = named.agg(F.sum(F.char_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // (CHUNK_CHARS * FOLDS))) * FOLDS
    within = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks // FOLDS)).cast("int")
    dealt = named.withColumn("chunk", within * FOLDS + _fold()).mapInArrow(_packed, "chunk int, block binary").repartition(chunks, "chunk")

    def distinct(batches):
        found: dict[int, _Distinct] = {}
        for batch in batches:
            chunk = batch.column("chunk").to_numpy()
            for c in np.unique(chunk).tolist():
                for part in _unpacked(batch.column("block").filter(pa.array(chunk == c))):
                    found.setdefault(c, _Distinct()).add(part.column("text").to_pylist())
        for c, grams in found.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams.counts), c, np.int32)), pa.array(grams.strings(), pa.string())], names=["chunk", "gram"])

    def score(texts: pa.Table, grams: pa.Table) -> pa.Table:
        joined = "".join(grams.column("gram").to_pylist())
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        hashes, logp = _hashes(points)[::ORDER], grams.column("logp").to_numpy().astype(float)
        order = np.argsort(hashes)
        hashes, logp = hashes[order], logp[order]
        parts = []
        for part in _unpacked(texts.column("block")):
            points, place, owner = _grams(part.column("text").to_pylist())
            own = logp[np.searchsorted(hashes, _hashes(points)[place])] if len(place) else np.zeros(0)
            n = np.bincount(owner, minlength=part.num_rows)
            value = -np.bincount(owner, weights=own, minlength=part.num_rows) / np.maximum(n, 1)
            parts.append(pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), pa.array(n), pa.array(value, mask=n == 0)], names=names))
        return pa.Table.from_batches(parts)

    names = ["doc_id", "lang", "n_grams", "log_perplexity"]
    kind = named.schema["doc_id"].dataType.simpleString()
    pairs = dealt.mapInArrow(distinct, "chunk int, gram string")
    scored = model.log_probability(pairs)
    return dealt.groupBy("chunk").cogroup(scored.groupBy("chunk")).applyInArrow(score, f"doc_id {kind}, lang string, n_grams long, log_perplexity double")


def quality(docs: DataFrame, labels: DataFrame, quantile: float = KEEP_QUANTILE) -> DataFrame:
    """``(doc_id, lang, n_grams, perplexity, threshold, keep)`` for each row of ``docs``.

    Trusted text is that of documents with a ``quality`` label of 1. A document
    stays if its perplexity is at most its language's threshold: the quantile of
    the trusted documents of the language, or of all trusted ones for a language
    that has none (as for a null language). Text that a model has learned is
    likelier than text of the same kind, so every text is scored by the model of
    the trusted text outside its fold: all trusted documents are learned from, and
    all give quantiles. Quantiles are exact to a step of log-perplexity and the
    same at every run.

    A null or blank text has no perplexity and does not stay. Without trusted
    text nothing tells documents apart: perplexity is that of a uniform choice
    and all with a text stay. Ids that are labelled twice count once; repeated
    rows each have a result.
    """
    # Written, so that Spark knows its size: ids below its broadcast threshold leave the texts where they are.
    good = saved(labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "trusted")
    likely = sifted(docs.select("doc_id", "text"), "doc_id", good, "doc_id")
    model = KneserNey.train(likely.join(good, "doc_id", "left_semi"))
    scored = saved(with_perplexity(docs, model), "perplexity")
    step = F.ceil(F.col("log_perplexity") * STEPS).cast("long")
    marked = scored.join(good, "doc_id", "left_semi").where("log_perplexity IS NOT NULL")
    counts = marked.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    counts = saved(counts, "steps")
    pooled = counts.groupBy("step").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(None).cast("string"))
    counts = counts.where("lang IS NOT NULL").unionByName(pooled)
    up_to = Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("lang")
    at = counts.withColumns({"below": F.sum("n").over(up_to), "all": F.sum("n").over(whole)}).where(F.col("below") >= F.lit(quantile) * F.col("all"))
    limits = saved(at.groupBy("lang").agg((F.min("step") / STEPS).alias("limit")), "limits")
    pooled = limits.where("lang IS NULL").first()
    otherwise = F.lit(float(pooled["limit"]) if pooled else float("inf"))
    out = scored.join(limits.where("lang IS NOT NULL").withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"), "left")
    limit = F.coalesce("limit", otherwise)
    return out.select(
        "doc_id",
        "lang",
        "n_grams",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp(limit).alias("threshold"),
        F.coalesce(F.col("log_perplexity") <= limit, F.lit(False)).alias("keep"),
    )
