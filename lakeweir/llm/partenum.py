"""Similarity join of documents on word n-grams with PartEnum signatures.

Documents link when the Jaccard similarity of their sets of distinct word
n-grams reaches a threshold. Similar sets have similar sizes, and in a band of
sizes a bound on how many elements can differ. The feature domain is dealt by
hash into partitions, each again into parts: with the differences spread over
them, some partition holds so few that a subset of its parts has none. A
signature for each such subset of each partition therefore makes any two linked
sets share at least one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import each_group, in_block_pairs, saved, sifted, text_slices
from lakeweir.llm.graph import components
from lakeweir.llm.words import SPACE, grams, mix, words_of

#: Members of a bucket in a block, and n-grams of a cluster in a block.
BLOCK_MEMBERS = 4096
BLOCK_GRAMS = 2_000_000
#: Parts of a partition, and how many of them a signature leaves out.
PARTS, LEFT_OUT = 2, 1
SUBSETS = np.array(list(combinations(range(PARTS), PARTS - LEFT_OUT)))


def size_bands(percent: int, largest: int) -> np.ndarray:
    """The first size of each band: no two sets link over more than one border."""
    firsts = [1]
    while firsts[-1] <= largest:
        firsts.append(firsts[-1] * 100 // percent + 1)
    firsts.append(firsts[-1] * 100 // percent + 1)
    firsts.append(firsts[-1] * 100 // percent + 1)
    return np.array(firsts)


def most_differences(percent: int, sizes: np.ndarray) -> np.ndarray:
    """How many elements two linked sets can have apart, given the sum of their sizes."""
    return (100 - percent) * sizes // (100 + percent)


class GramSets:
    """The sorted distinct n-gram hashes of each text of an array."""

    def __init__(self, texts: pa.Array, n: int):
        words = words_of(texts, SPACE)
        counts = np.diff(words.starts)
        hashes = grams(words.hashes, n)
        lengths = np.maximum(counts - n + 1, 0)
        inside = np.repeat(words.starts[:-1] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        short = np.flatnonzero((counts > 0) & (counts < n))
        lengths[short] = 1
        starts = np.concatenate(([0], np.cumsum(lengths)))
        flat = np.zeros(starts[-1], np.uint64)
        is_short = np.zeros(len(flat), bool)
        is_short[starts[short]] = True
        flat[~is_short] = hashes[np.arange(len(inside)) + inside]
        for i in short:  # fewer words than n: the whole sequence is the one element
            flat[starts[i]] = grams(words.hashes[words.starts[i] : words.starts[i + 1]], counts[i])[0] ^ np.uint64(counts[i])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            flat[a:b].sort()
        owner = np.repeat(np.arange(len(lengths)), lengths)
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        self.flat, self.owner = flat[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(lengths))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))

    def of(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.starts[i + 1]]

    def keys(self) -> np.ndarray:
        """64 bits that equal sets share; 0 for empty sets."""
        out = np.zeros(len(self.sizes), np.int64)
        for i in np.flatnonzero(self.sizes):
            out[i] = int.from_bytes(hashlib.blake2b(self.of(i).tobytes(), digest_size=8).digest(), "little", signed=True)
        return out


def sketches(sets: GramSets, percent: int) -> list[bytes | None]:
    """For each set, parities of how many elements fall on each of many bits.

    Two sets differ in at least as many elements as their parities differ in
    bits, so the parities can rule a link out and never lose one.
    """
    wanted = np.maximum(4 * most_differences(percent, 3 * sets.sizes), 256)
    bits = (1 << np.ceil(np.log2(wanted)).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(bits)))
    at = offsets[sets.owner] + (mix(sets.flat ^ np.uint64(0xA5)) & (bits[sets.owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=offsets[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [odd[a // 8 : b // 8] if n else None for a, b, n in zip(offsets[:-1], offsets[1:], sets.sizes, strict=True)]


def signatures(sets: GramSets, chosen: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, signature)`` of the chosen sets.

    A set takes part in the joins of its own band with the next and of the band
    before with its own. Empty subsets are signed only by sets that have more of
    them than the spare partitions: of any two linked sets, either both have
    that many, or one shares a subset with elements in it.
    """
    bands = size_bands(percent, int(sets.sizes.max(initial=1)))
    band = np.searchsorted(bands, sets.sizes, side="right") - 1
    least = -(-percent // (100 - percent))  # smaller sets link with equal ones only
    keep = chosen & (sets.sizes >= least)
    element_kept = keep[sets.owner]
    flat, owner = sets.flat[element_kept], sets.owner[element_kept]
    owners, out = [], []
    for back in (0, 1):
        instance = band - back
        apart = most_differences(percent, 2 * (bands[np.minimum(instance + 2, len(bands) - 1)] - 1))
        spare = 1 + apart // 80
        partitions = np.where(keep & (instance >= 0), apart // (LEFT_OUT + 1) + 1 + spare, 0)
        offsets = np.concatenate(([0], np.cumsum(partitions * PARTS)))
        mine = instance[owner] >= 0
        e, o = flat[mine], owner[mine]
        salt = mix(instance[o].astype(np.uint64) + np.uint64(0x51ED27))
        part = (mix(e ^ salt) % (partitions[o] * PARTS).astype(np.uint64)).astype(np.int64)
        sums, at = np.zeros(offsets[-1], np.uint64), offsets[o] + part
        np.add.at(sums, at, mix(e + salt))
        filled = np.bincount(at, minlength=offsets[-1])
        # One row for each partition of each set, one column for each subset of its parts.
        sums, filled = sums.reshape(-1, PARTS), filled.reshape(-1, PARTS)
        of = np.repeat(np.arange(len(partitions)), partitions)
        number = np.arange(len(of)) - np.repeat(offsets[:-1] // PARTS, partitions)
        weights = mix(np.arange(1, PARTS + 1, dtype=np.uint64))
        subset = np.stack([(mix(sums[:, s]) * weights[s]).sum(axis=1) for s in SUBSETS], axis=1)
        empty = np.stack([filled[:, s].sum(axis=1) == 0 for s in SUBSETS], axis=1)
        label = mix(instance[of].astype(np.uint64) * np.uint64(1_000_003) + (number * len(SUBSETS)).astype(np.uint64))
        signed = mix(subset + label[:, None] + mix(np.arange(7, 7 + len(SUBSETS), dtype=np.uint64)))
        gaps = np.bincount(of, weights=empty.any(axis=1), minlength=len(partitions))
        use = ~empty | (gaps > spare)[of][:, None]
        owners.append(np.repeat(of, len(SUBSETS))[use.ravel()])
        out.append(signed.ravel()[use.ravel()])
    return np.concatenate(owners), np.concatenate(out).view(np.int64)


def forest(n: int, near, two_sided: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Edges that join what ``near`` joins: every member is compared with those not yet reached.

    ``near(u, others)`` says which of the others are near ``u``. With
    ``two_sided``, only members of different sides are compared.
    """
    left = np.arange(n)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            u = queue.pop()
            reached = near(u, left)
            if two_sided is not None:
                reached &= two_sided[left] != two_sided[u]
            for v in left[reached]:
                queue.append(int(v))
                yield u, int(v)
            left = left[~reached]


def _edges(keys: np.ndarray, found: Iterator[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(list(found), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(keys[pairs[:, 0]]), pa.array(keys[pairs[:, 1]])], names=["u", "v"])


def _sides(group: pa.Table) -> np.ndarray | None:
    lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    return None if lo == hi else group.column("block").to_numpy() == hi


class SimilarDocuments:
    """The join for one n-gram length and threshold; see :func:`similar_components`."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int):
        self.n, self.percent = n, percent
        text = F.col(text_col)
        self.docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))

    def rows(self) -> DataFrame:
        """Each document with the size, key and parities of its set."""
        n, percent = self.n, self.percent

        def work(batches):
            for batch in batches:
                for part in text_slices(batch, "text"):
                    sets = GramSets(part.column("text"), n)
                    keys = pa.array(sets.keys(), mask=sets.sizes == 0)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("text_hash"), keys, pa.array(sets.sizes.astype(np.int64)),
                         pa.array(sketches(sets, percent), pa.binary())],
                        names=["doc_id", "text_hash", "set_key", "n_shingles", "parities"],
                    )

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, text_hash long, set_key long, n_shingles long, parities binary"
        return self.docs.mapInArrow(work, schema)

    def shared_signatures(self) -> DataFrame:
        """``(bucket, set_key, members)`` of signatures that different sets share.

        A task signs each set once, so copies do not pile up on their signatures.
        Signatures with the same members make one bucket: near copies share most
        of theirs and are compared once.
        """
        n, percent = self.n, self.percent

        def work(batches):
            signed: set[int] = set()
            for batch in batches:
                for part in text_slices(batch, "text"):
                    sets = GramSets(part.column("text"), n)
                    keys = sets.keys()
                    chosen = np.zeros(len(keys), bool)
                    for i in np.flatnonzero(sets.sizes):
                        chosen[i] = int(keys[i]) not in signed
                        signed.add(int(keys[i]))
                    owner, values = signatures(sets, chosen, percent)
                    yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(keys[owner])], names=["signature", "set_key"])

        all_of_it = Window.partitionBy("signature")
        return (
            self.docs.select("text")
            .mapInArrow(work, "signature long, set_key long")
            .withColumns({"least": F.min("set_key").over(all_of_it), "most": F.max("set_key").over(all_of_it),
                          "members": F.count("*").over(all_of_it), "mixed": F.bit_xor(F.xxhash64("set_key")).over(all_of_it)})
            .where("least <> most")
            .select(F.xxhash64("least", "most", "members", "mixed").alias("bucket"), "set_key", "members")
            .distinct()
        )

    def candidate_edges(self, rows: DataFrame) -> DataFrame:
        """Edges that connect all pairs of a bucket that the parities leave possible."""
        percent = self.percent

        def compare(group: pa.Table):
            keys, sizes = group.column("set_key").to_numpy(), group.column("n_shingles").to_numpy()
            blobs = group.column("parities").to_pylist()
            width = min(map(len, blobs))
            bits = np.zeros((len(keys), width // 8), np.uint64)
            for i, blob in enumerate(blobs):  # longer ones fold onto the shortest
                bits[i] = np.bitwise_xor.reduce(np.frombuffer(blob, np.uint64).reshape(-1, width // 8), axis=0)

            def near(u, others):
                apart = np.bitwise_count(bits[others] ^ bits[u]).sum(axis=1, dtype=np.int64)
                a, b = sizes[u], sizes[others]
                return ((100 + percent) * apart <= (100 - percent) * (a + b)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))

            yield _edges(keys, forest(len(keys), near, _sides(group)))

        shared = saved(self.shared_signatures(), "signatures")
        sets = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.first("n_shingles").alias("n_shingles"), F.first("parities").alias("parities"))
        members = shared.join(sets, "set_key")
        dealt = in_block_pairs(members, "set_key", F.ceil(F.col("members") / BLOCK_MEMBERS))
        keys = ["bucket", "lo", "hi"]
        return (
            dealt.select(*keys, "block", "set_key", "n_shingles", "parities")
            .repartition(*keys)
            .sortWithinPartitions(*keys)
            .mapInArrow(lambda batches: each_group(batches, keys, compare), "u long, v long")
        )

    def links(self, rows: DataFrame) -> DataFrame:
        """Verified links that connect all that is linked; fewer than all links where sets are many."""
        n, percent = self.n, self.percent

        def to_sets(batches):
            for batch in batches:
                for part in text_slices(batch, "text"):
                    sets = GramSets(part.column("text"), n)
                    blobs = pa.array([sets.of(i).tobytes() for i in range(part.num_rows)], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column("cluster"), part.column("blocks"), part.column("set_key"), blobs], names=["cluster", "blocks", "set_key", "grams"])

        def verify(group: pa.Table):
            keys, first = np.unique(group.column("set_key").to_numpy(), return_index=True)
            sides = _sides(group)
            sides = None if sides is None else sides[first]
            blobs = [group.column("grams")[int(i)].as_py() for i in first]
            sizes = np.array([len(b) // 8 for b in blobs])
            ids = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True)[1]
            starts = np.concatenate(([0], np.cumsum(sizes)))
            marked = np.zeros(int(ids.max()) + 1, bool)
            held = {}

            def near(u, others):
                # The elements of those left, gathered anew when a tenth of them has gone.
                if not held or len(others) < 0.9 * len(held["of"]):
                    held["of"] = others
                    held["ids"] = np.concatenate([ids[starts[v] : starts[v + 1]] for v in others])
                    held["starts"] = np.concatenate(([0], np.cumsum(sizes[others])))[:-1]
                own = ids[starts[u] : starts[u + 1]]
                marked[own] = True
                common = np.add.reduceat(marked[held["ids"]], held["starts"], dtype=np.int64)
                marked[own] = False
                common = common[np.searchsorted(held["of"], others)]
                return 100 * common >= percent * (sizes[u] + sizes[others] - common)

            yield _edges(keys, forest(len(keys), near, sides))

        candidates = saved(self.candidate_edges(rows).distinct(), "candidates")
        clusters = components(candidates, "u", "v").withColumnRenamed("root", "cluster")
        one_each = rows.join(clusters, F.col("set_key") == F.col("id")).groupBy("set_key", "cluster").agg(
            F.min(F.struct("text_hash", "doc_id", "n_shingles")).alias("one")
        )
        one_each = saved(one_each.select("set_key", "cluster", "one.*"), "clusters")
        sizes = one_each.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / BLOCK_GRAMS).alias("blocks"))
        one_each = one_each.join(sizes, "cluster").withColumnsRenamed({"doc_id": "one_id", "text_hash": "one_hash"})
        texts = sifted(self.docs, "text_hash", one_each, "one_hash").join(one_each, (F.col("text_hash") == F.col("one_hash")) & F.col("doc_id").eqNullSafe(F.col("one_id")))
        dealt = in_block_pairs(
            texts.select("cluster", "blocks", "set_key", "text").mapInArrow(to_sets, "cluster long, blocks long, set_key long, grams binary"),
            "set_key",
            F.col("blocks"),
        )
        keys = ["cluster", "lo", "hi"]
        return (
            dealt.select(*keys, "block", "set_key", "grams")
            .repartition(*keys)
            .sortWithinPartitions(*keys)
            .mapInArrow(lambda batches: each_group(batches, keys, verify), "u long, v long")
        )


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: what each document is joined to by links.

    Words are runs of other than white space, with A-Z lower-cased; a set holds
    the distinct runs of ``n`` words, or with fewer words the whole sequence.
    Two documents link when ``100 * common >= percent * union``. ``component_id``
    is the smallest id that links lead to. No pair is listed that a chain of
    other links already joins, so copies and large groups cost about their size;
    within a group that shares a signature, candidates are compared in blocks of
    bounded size.

    A null or empty text, or one of white space, has ``n_shingles`` 0 and links
    with nothing. A null id is no component's id unless all of its members have
    null; repeated rows and ids each keep their own row. Other columns are not
    read. Sets are told apart by 64 bits: with a billion different sets, the
    odds that any two are confused are about 3 %.
    """
    join = SimilarDocuments(docs, id_col, text_col, n, percent)
    rows = saved(join.rows(), "sets")
    labels = components(saved(join.links(rows), "links"), "u", "v")
    labelled = rows.select("doc_id", "n_shingles", "set_key").join(labels, F.col("set_key") == F.col("id"), "left")
    labelled = labelled.select("doc_id", "n_shingles", F.coalesce("root", "set_key").alias("root"))
    least = labelled.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = labelled.join(least.withColumnRenamed("root", "to"), F.col("root") == F.col("to"), "left")
    return out.select(
        F.col("doc_id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )
