"""Exact k-means over integer vectors by Shallot search.

Every vector remembers its nearest and its second-nearest centroid, an upper
bound of its distance to the first and a lower bound of its distance to all
others. Centroids move, so bounds widen by how far; while the upper one stays
below the lower one, or below half the way from the centroid to its closest
neighbour, nothing has to be computed. Otherwise both remembered centroids are
measured, the closer one becomes the middle of a ball, and its neighbours are
scanned from the closest on. No centroid beyond the vector's distance to the
middle plus its distance to the second best so far can be among the best two;
that radius shrinks with each find and ends the scan. What is left is compared
by squared distances in 64-bit integers, ties by number, so bounds in floating
point only ever save work.

Vectors move about in blocks of some thousand, a row each: a round is one pass
without a shuffle in which each block writes its new state and its sums for the
next centroids. Centroids alone (``k`` times the dimension) go through the driver.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.llm.common import freed, shared_folder

#: Vectors in a block.
BLOCK_ROWS = 8192
#: By this part bounds are taken wider than computed: far more than rounding can be off.
SLACK = 1e-9

_STATE = (
    "ids array<{id}>, width int, vectors binary, nearest binary, second binary, upper binary, lower binary, sums binary, counts binary"
)
_NAMES = ["ids", "width", "vectors", "nearest", "second", "upper", "lower", "sums", "counts"]


def integer_vectors(df: DataFrame, size: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: vectors of exactly ``size`` finite components, each as ``floor(scale * x)``; others go."""
    given = F.col(vector_col)
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    # A condition with a null component is null, so is one over a null vector.
    whole = df.where(F.coalesce((F.size(given) == size) & finite, F.lit(False)))
    return whole.select(F.col(id_col).alias("vec_id"), F.transform(given, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def largest_component(size: int) -> int:
    """Up to this magnitude, no squared distance of two vectors leaves 63 bits."""
    return math.isqrt((1 << 63) // max(size, 1) - 1) // 2


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<salt>:<vec_id>``, in that order.

    Null ids come last, and rows of one id go by their components. A limit on the hash, taken
    from the number of rows, leaves a few hundred rows to order.
    """
    digest = F.coalesce(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256), F.lit("z"))
    marked = vectors.select(digest.alias("digest"), "v")
    share = (k + 10 * math.sqrt(k) + 10) / max(vectors.count(), 1)
    while True:
        few = marked if share >= 0.5 else marked.where(F.col("digest") < f"{int(share * 16**12):012x}")
        found = few.orderBy("digest", "v").limit(k).collect()
        if len(found) == k or share >= 0.5:
            return np.array([row["v"] for row in found], np.int64)
        share *= 4


class Centroids:
    """Centroids with what a search needs of their geometry, and how far each has moved."""

    def __init__(self, places: np.ndarray, before: np.ndarray | None = None):
        self.places = places
        between = np.stack([np.sqrt(squared(places, c).astype(float)) for c in places])
        self.between = between
        self.order = [row[row != i] for i, row in enumerate(np.argsort(between, axis=1, kind="stable"))]
        far = between + np.diag(np.full(len(places), np.inf))
        self.half = far.min(axis=1) / 2
        moved = np.zeros(len(places)) if before is None else np.sqrt(squared(places, before).astype(float))
        self.moved = moved * (1 + SLACK)
        # How far any other centroid has moved: the greatest move, for its own centroid the next one.
        top = np.argsort(-self.moved, kind="stable")[:2]
        self.others_moved = np.full(len(places), self.moved[top[0]])
        self.others_moved[top[0]] = self.moved[top[1]] if len(top) > 1 else 0.0


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances in 64-bit integers of the rows of ``a`` to ``b`` (a row, or a row each)."""
    gap = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", gap, gap)


class Block:
    """Some vectors and what is remembered of each."""

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        self.vectors = vectors
        self.nearest, self.second = np.zeros(n, np.int32), np.ones(n, np.int32)
        self.upper, self.lower = np.full(n, np.inf), np.zeros(n)
        self.searched = 0

    def assign(self, c: Centroids) -> None:
        """Find every vector's nearest centroid, the smaller number where two are as near."""
        x, k = self.vectors, len(c.places)
        if k == 1:
            return
        self.upper += c.moved[self.nearest]
        self.lower -= c.others_moved[self.nearest]
        loose = np.flatnonzero(~self.settled(c, slice(None)))
        own = squared(x[loose], c.places[self.nearest[loose]])
        self.upper[loose] = np.sqrt(own.astype(float))
        still = ~self.settled(c, loose)
        rows, first = loose[still], own[still]
        self.searched = len(rows)
        if not len(rows):
            return
        first_at = self.nearest[rows]
        other, other_at = squared(x[rows], c.places[self.second[rows]]), self.second[rows]
        swap = (other < first) | ((other == first) & (other_at < first_at))
        best, best_at = np.where(swap, other, first), np.where(swap, other_at, first_at)
        next_, next_at = np.where(swap, first, other), np.where(swap, first_at, other_at)
        middle, known = best_at.copy(), next_at.copy()
        radius = np.sqrt(best.astype(float))
        order = np.argsort(middle, kind="stable")
        cuts = np.searchsorted(middle[order], np.arange(k + 1))
        for m in range(k):
            live = order[cuts[m] : cuts[m + 1]]
            for t in c.order[m]:
                live = live[c.between[m, t] <= (radius[live] + np.sqrt(next_[live].astype(float))) * (1 + SLACK) + SLACK]
                if not len(live):
                    break
                go = live[known[live] != t]
                d = squared(x[rows[go]], c.places[t])
                wins = (d < best[go]) | ((d == best[go]) & (t < best_at[go]))
                places = ~wins & ((d < next_[go]) | ((d == next_[go]) & (t < next_at[go])))
                up, at = go[wins], go[places]
                next_[up], next_at[up] = best[up], best_at[up]
                best[up], best_at[up] = d[wins], t
                next_[at], next_at[at] = d[places], t
        self.nearest[rows], self.second[rows] = best_at, next_at
        self.upper[rows], self.lower[rows] = np.sqrt(best.astype(float)), np.sqrt(next_.astype(float))

    def settled(self, c: Centroids, rows) -> np.ndarray:
        """Which of the rows have bounds that no other centroid can be within."""
        rest = np.maximum(self.lower[rows], c.half[self.nearest[rows]])
        return self.upper[rows] * (1 + SLACK) + SLACK < rest * (1 - SLACK)

    def sums(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Component sums and sizes of the clusters in this block."""
        counts = np.bincount(self.nearest, minlength=k)
        sums = np.zeros((k, self.vectors.shape[1]), np.int64)
        used = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[used]
        sums[used] = np.add.reduceat(self.vectors[np.argsort(self.nearest, kind="stable")].astype(np.int64), starts, axis=0)
        return sums, counts

    def row(self, ids: pa.Array, k: int) -> pa.RecordBatch:
        """The block as a row of the state table; components take the narrowest width that holds them."""
        top = int(np.abs(self.vectors).max(initial=0))
        width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
        sums, counts = self.sums(k)
        blobs = (self.vectors.astype(f"<i{width}"), self.nearest.astype("<i4"), self.second.astype("<i4"), self.upper, self.lower, sums, counts.astype("<i8"))
        lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        columns = [lists, pa.array([width], pa.int32()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    @classmethod
    def of(cls, row: dict) -> Block:
        n = len(row["ids"].values)
        block = cls(np.frombuffer(row["vectors"].as_py(), f"<i{row['width'].as_py()}").reshape(n, -1))
        block.nearest, block.second = (np.frombuffer(row[f].as_py(), "<i4").copy() for f in ("nearest", "second"))
        block.upper, block.lower = (np.frombuffer(row[f].as_py(), "<f8").copy() for f in ("upper", "lower"))
        return block


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _first_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, Block]]:
    """Blocks of full size from batches of any size."""
    limit, held, n = largest_component(size), [], 0

    def block():
        table = pa.Table.from_batches(held).combine_chunks()
        v = table.column("v").combine_chunks()
        vectors = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), size)
        if len(vectors) and max(int(vectors.max()), -int(vectors.min())) > limit:
            raise ValueError(f"components beyond {limit} in magnitude: squared distances would not fit 64 bits")
        return table.column("vec_id").combine_chunks(), Block(vectors)

    for batch in batches:
        while batch.num_rows:
            part, batch = batch.slice(0, BLOCK_ROWS - n), batch.slice(BLOCK_ROWS - n)
            held, n = [*held, part], n + part.num_rows
            if n == BLOCK_ROWS:
                yield block()
                held, n = [], 0
    if held:
        yield block()


def _moved(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Every non-empty centroid at the exact floor of its mean; empty ones where they were."""
    k, size = before.shape

    def totals(batches):
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for row in _rows(batches):
            sums += np.frombuffer(row["sums"].as_py(), "<i8").reshape(k, size)
            counts += np.frombuffer(row["counts"].as_py(), "<i8")
        used = np.flatnonzero(counts)
        parts = np.concatenate((sums[used], counts[used, None]), axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, size + 1), pa.int32()), pa.array(np.tile(np.arange(size + 1), len(used)), pa.int32()), pa.array(parts.ravel())],
            names=["cluster", "place", "part"],
        )

    parts = state.select("sums", "counts").mapInArrow(totals, "cluster int, place int, part long")
    found = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    sums: dict[int, dict[int, int]] = {}
    for row in found:
        sums.setdefault(row["cluster"], {})[row["place"]] = int(row["total"])
    after = before.copy()
    for cluster, of in sums.items():
        after[cluster] = [of[i] // of[size] for i in range(size)]
    return after


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(vectors: DataFrame, size: int, k: int = 40, rounds: int = 5, salt: str = "2") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of ``integer_vectors``.

    Centroids start as :func:`seeds`; each round assigns all vectors and moves
    every non-empty centroid to the floor of its mean; a last assignment
    follows. With fewer than ``k`` vectors there are as many centroids; without
    any the result is empty. Rows of one id are vectors of their own, null ids
    too. Components whose squared distances do not fit 64 bits raise. The state
    of a round frees that of the one before; the last one stays for the result.
    """
    spark: SparkSession = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    places = seeds(vectors, k, salt)
    if not len(places):
        return spark.createDataFrame([], out)
    state_schema, base = _STATE.format(id=kind), f"{shared_folder(spark)}/llm/shallot-{uuid.uuid4().hex}"
    start, k = Centroids(places), len(places)

    def begin(batches):
        for ids, block in _first_blocks(batches, size):
            block.assign(start)
            yield block.row(ids, k)

    state = _kept(vectors.mapInArrow(begin, state_schema), f"{base}/0")
    for number in range(1, rounds + 1):
        before, places = places, _moved(state, places)
        centroids = Centroids(places, before)

        def further(batches, centroids=centroids):
            for row in _rows(batches):
                block = Block.of(row)
                block.assign(centroids)
                yield block.row(row["ids"].values, k)

        state = _kept(state.mapInArrow(further, state_schema), f"{base}/{number}")
        freed(spark, f"{base}/{number - 1}")

    def members(batches):
        for row in _rows(batches):
            block = Block.of(row)
            distances = squared(block.vectors, places[block.nearest])
            yield pa.RecordBatch.from_arrays([row["ids"].values, pa.array(block.nearest), pa.array(distances)], names=["vec_id", "cluster", "distance"])

    found = state.drop("sums", "counts").mapInArrow(members, f"vec_id {kind}, cluster int, distance long")
    sums = {row["cluster"]: int(row["total"]) for row in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places.tolist()]
    about = spark.createDataFrame(
        [(i, sums.get(i, 0), sum(sums.values()), digests[i]) for i in range(k)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(about, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
