"""Tables, shared intermediate storage, and streams of groups inside tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes of text that numpy works on at a time inside a task.
SLICE_BYTES = 1 << 20
#: Bits of the map that sorts out rows which a join would drop.
MAP_BITS = 1 << 24


#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def prepared(step):
    """A query or stage whose session lets Python workers import this package and sends them small batches.

    Batches of bounded bytes keep a worker's memory apart from the length of texts.
    """

    @wraps(step)
    def run(spark: SparkSession, *args):
        paths = spark.sparkContext.environment.get("PYTHONPATH", "")
        if ROOT not in paths.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}".rstrip(":")
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * SLICE_BYTES))
        return step(spark, *args)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder beside the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate").rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The plan behind it is cut, lost executors lose none of it, and later steps
    read only the columns they use. The folder is left for its owner to clear.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that this worker has freed to the system, so that a worker kept for later holds little.

    Where the C library has no such call, it is left to that library.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same task, which gives memory back when it ends."""

    def run(batches):
        yield from work(batches)
        give_back()

    return run


def freed(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by bytes of text, so that numpy's working memory stays bounded.

    A single text longer than ``limit`` makes a slice of its own.
    """
    lengths = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64, len(lengths) + 1 + lengths.offset)[lengths.offset :])
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def each_group(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Call ``work`` for each run of equal keys in a sorted stream of batches.

    Cheaper than one Python call per group where most groups are tiny; what is
    held is one group.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            now = tuple(c[a] for c in columns)
            if (i or last is not None) and now != last and held:
                yield from work(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield from work(pa.Table.from_batches(held))


def in_block_pairs(df: DataFrame, member: str, blocks: Column) -> DataFrame:
    """Deal the members of a group over pairs of blocks.

    A group of ``blocks`` blocks becomes one task per pair of blocks (``lo``,
    ``hi``), so that any two members meet in exactly one and no task holds more
    than two blocks, whatever the size of the group. ``block`` is a member's own.
    """
    n = F.greatest(F.lit(1), blocks.cast("int"))
    return (
        df.withColumn("n_blocks", n)
        .withColumn("block", F.pmod(F.xxhash64(member, F.lit(17)), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .drop("other", "n_blocks")
    )


def sifted(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows of ``df`` whose key falls on a bit that a wanted key sets.

    A join that follows then moves about the rows it keeps. The map of bits has
    a fixed size, so every task can hold it: no wanted row is lost, others stay
    by chance, the more of them the fuller the map. Rows with a null key stay
    where a wanted key is null.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({wanted_key}), {MAP_BITS}) % 32 AS INT))")
    words = wanted.groupBy(F.shiftright(place(wanted_key), 5).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    bits = np.zeros(MAP_BITS // 32, np.uint32)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def keep(batches):
        for batch in batches:
            at = batch.column("__place").to_numpy()
            on = (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1
            yield batch.filter(pa.array(on.astype(bool))).drop_columns(["__place"])

    return df.withColumn("__place", place(key)).mapInArrow(keep, df.schema)


def sifted_by_join(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """As :func:`sifted`, on built-in functions alone: the words of the map are one side of a broadcast join."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({wanted_key}), {MAP_BITS}) % 64 AS INT))")
    words = wanted.groupBy(F.shiftright(place(wanted_key), 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    found = df.withColumn("__place", place(key)).join(F.broadcast(words), F.shiftright("__place", 6) == F.col("__word"))
    on = F.expr("shiftrightunsigned(__bits, cast(__place % 64 AS INT)) & 1L = 1")
    return found.where(on).drop("__place", "__word", "__bits")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Each row's place, from 0, in the order of the whole frame.

    Rows are dealt by range and sorted in their tasks; a place is the row's in
    its task plus the rows of the tasks before. Meant for narrow rows: they are
    written once.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = saved(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranged")
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_least"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))
    return ranged.join(parts, "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")
