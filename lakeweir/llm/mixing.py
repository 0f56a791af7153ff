"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies: the source's
target over its size. The whole part is certain; the fractions are rounded in
pairs. Each pair moves mass from one document to the other, in words, until one
of the two is integral, so the words of the mix stay as they are and each
document keeps its expectation. One document per task stays fractional; these
residuals go through the same rounding again, in a tree of tasks. The last one of
a source goes to its nearer side, which leaves at most half its words over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import each_group, numbered, saved

#: Weights of sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MOST_COPIES = 3
#: Documents, or residuals, that one task pairs.
FAN_IN = 2000


def pair_up(sizes: np.ndarray, fractions: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Round all but at most one of the fractions to 0 or 1, keeping ``sizes @ fractions``.

    ``draws`` are uniform from 0 to 1. A step raises one fraction by ``up`` or
    lowers it by ``down``, with odds that keep its expectation, and changes the
    other so that their words stay the same.
    """
    out = fractions.astype(float).copy()
    open_one = -1
    for i in range(len(out)):
        if out[i] <= 0 or out[i] >= 1:
            continue
        if open_one < 0:
            open_one = i
            continue
        j, ratio = open_one, sizes[open_one] / sizes[i]
        p, q = out[j], out[i]
        up, down = min(1 - p, q / ratio), min(p, (1 - q) / ratio)
        if draws[i] * (up + down) < down:
            out[j], out[i] = (1.0, q - up * ratio) if 1 - p <= q / ratio else (p + up, 0.0)
        else:
            out[j], out[i] = (0.0, q + down * ratio) if p <= (1 - q) / ratio else (p - down, 1.0)
        for k in (i, j):  # what is left of rounding errors of floats
            out[k] = 0.0 if out[k] < 1e-12 else 1.0 if out[k] > 1 - 1e-12 else out[k]
        open_one = i if 0 < out[i] < 1 else j if 0 < out[j] < 1 else -1
    return out


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``(source, number, n_docs, source_size, target)`` for the sources of ``(source, size)`` rows.

    Targets share the sum of all sizes by weight and stop at ``most`` times the
    size of their source; what is over goes to the others by weight, until none
    is above.
    """
    sources = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = numbered(sources, [F.col("source").asc_nulls_last()], "number")
    sources = saved(sources.withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int"))), "sources")
    cap = F.col("source_size") * most
    level, stopped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(above, cap)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["weight"]:
            break
        stopped = row["stopped"]
        level = ((row["words"] or 0) - (row["capped"] or 0)) / row["weight"]
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double")).cast("double")
    return sources.select("source", "number", "n_docs", "source_size", target.alias("target"))


def _rounded(group: pa.Table, last: bool):
    """One task's documents, largest first, so that what stays open is small."""
    sizes, draws = group.column("size").to_numpy(), group.column("draw").to_numpy()
    order = np.lexsort((draws, -sizes))
    group = group.take(pa.array(order))
    out = pair_up(sizes[order].astype(float), group.column("fraction").to_numpy(), draws[order])
    if last:
        left = (out > 0) & (out < 1)
        out[left] = np.round(out[left])
    at = group.schema.get_field_index("fraction")
    yield from group.set_column(at, "fraction", pa.array(out)).to_batches()


def mixed(docs: DataFrame, keep: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` for each row of ``docs``.

    ``size`` counts the words of ``text`` (runs of other than white space; null:
    0), ``target`` is that of the document's source, ``copies`` says how often
    the mix has the document and ``taken`` is ``copies * size``. Sources rank by
    code point, null last, and take ``weights`` in turn. Copies are at most
    ``most``. Every draw comes from the id and text, so reruns agree.

    Documents without words change no sum: they are rounded each by its own
    draw. Repeated rows are documents of their own. ``keep`` names more columns
    to hand through. An empty table gives no rows.
    """
    keep = keep or []
    held = [f"__keep_{i}" for i in range(len(keep))]
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(5)), 11) / float(1 << 53)
    rows = saved(docs.select("doc_id", "source", words.alias("size"), draw.alias("draw"), *[F.col(c).alias(h) for c, h in zip(keep, held, strict=True)]), "sizes")
    targets = source_targets(rows.select("source", "size"), weights, most)
    targets = saved(targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)), "targets")
    widest = targets.agg(F.max("n_docs")).first()[0] or 0
    rows = rows.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    rows = rows.select(
        "doc_id", "size", "source_size", "target", "draw", "number", *held,
        F.floor("rate").alias("whole"),
        (F.col("rate") - F.floor("rate")).alias("fraction"),
        F.floor(F.pmod(F.xxhash64("draw"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / FAN_IN)))).cast("long").alias("task"),
    )
    alone = rows.where("size = 0").withColumn("fraction", (F.col("draw") < F.col("fraction")).cast("double"))
    level, done, tasks = rows.where("size > 0"), [alone], max(1, -(-widest // FAN_IN))
    while True:
        keys, last = ["number", "task"], tasks == 1
        level = saved(
            level.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda batches, last=last: each_group(batches, ["number", "task"], lambda g: _rounded(g, last)), level.schema),
            "rounded",
        )
        if last:
            done.append(level)
            break
        settled = "fraction = 0 OR fraction = 1"
        done.append(level.where(settled))
        level = level.where(f"NOT ({settled})").withColumn("task", F.expr(f"task div {FAN_IN}"))
        tasks = -(-tasks // FAN_IN)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = F.col("whole") + F.col("fraction").cast("long")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), *[F.col(h).alias(c) for c, h in zip(keep, held, strict=True)])
