"""Runs of repeating words: maximal stretches of a text that have a period.

A run of period ``q`` and length ``L`` shows as a stretch of ``L - q`` words that
each equal the word ``q`` further on, a diagonal. As ``L`` is at least
``max(least, 2q)``, that stretch has at least ``k`` words for every lag from
``k`` up to ``2k`` (for the smallest ``k``, half of ``least``, for all lags
below as well). So lags are worked through in classes of doubling ``k``:

* *Seeds.* Words are indexed by their ``k``-grams, and places of one document
  with the same gram and a lag of the class are paired. A place whose gram is
  inside a run found before, of a period up to ``k / 2``, is no seed itself
  unless it begins the run: a stretch that such grams lie on begins where one
  of its two runs does. That keeps the pairs near the number of words where a
  few words repeat for ever.
* *Furthest covered.* Pairs are taken lag by lag in order of place. A pair
  behind the furthest word that its lag has covered extends nothing new.
* *Extension.* What is left grows to both sides by binary search over prefix
  hashes.

Grams that repeat nowhere in their document are out of all further classes, so
ordinary text costs one sort. Hashes are polynomials modulo two primes over
random codes of the exact words: two stretches that differ pass for equal with
odds of about 2^-60 times their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import text_slices
from lakeweir.llm.words import SPACE, mix, text_bytes

_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
_BASES = (1_288_490_189, 927_361_853)


@dataclass
class Texts:
    """Words of many texts: ``codes`` are equal where words are; text ``i`` has those from ``starts[i]`` on."""

    raw: np.ndarray
    first: np.ndarray
    size: np.ndarray
    codes: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Texts:
        raw, offsets = text_bytes(texts)
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = ~SPACE[raw]
        # A text's first byte starts a word even if the text before ended in one.
        joined = inside[1:] & inside[:-1]
        joined[offsets[:-1][offsets[:-1] < len(raw)]] = False
        first = np.flatnonzero(inside[1:-1] & ~joined[: len(raw)])
        size = np.flatnonzero(inside[1:-1] & ~joined[1:]) + 1 - first
        bounds = np.concatenate(([0], np.cumsum(size)))
        words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(raw[inside[1:-1]])])
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(size) else np.zeros(0, np.int64)
        return cls(raw, first, size, codes, np.searchsorted(first, offsets))


class _Hashes:
    """Hashes of any stretch of words, from prefix sums."""

    def __init__(self, codes: np.ndarray):
        self.n = n = len(codes)
        top = int(codes.max(initial=0)) + 1
        self.sums, self.powers = [], []
        for i, (p, b) in enumerate(zip(_PRIMES, _BASES, strict=True)):
            power, done = np.ones(n + 1, np.int64), 1
            while done <= n:  # b ** (done + j) is b ** done times b ** j
                step = min(done, n + 1 - done)
                power[done : done + step] = power[:step] * pow(b, done, p) % p
                done += step
            code = np.random.default_rng(7919 + i).integers(1, p, top)[codes]
            sums = np.zeros(n + 1, np.int64)
            np.cumsum(code * power[:n] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(power)

    def grams(self, at: np.ndarray, k: int) -> np.ndarray:
        """A hash of the ``k`` words from each place on, whatever the place."""
        parts = []
        for p, s, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            parts.append((s[at + k] - s[at]) % p * power[self.n - at] % p)
        return ((parts[0] << 31) ^ parts[1]).astype(np.uint64)

    def same(self, at: np.ndarray, lag: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from a place on equal those ``lag`` further on."""
        out = np.ones(len(at), bool)
        for p, s, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            here, there = (s[at + length] - s[at]) % p, (s[at + lag + length] - s[at + lag]) % p
            out &= here * power[lag] % p == there
        return out


def _most(holds, limit: np.ndarray) -> np.ndarray:
    """The greatest length up to ``limit`` for which ``holds``, which no longer one does after a shorter fails."""
    low, high = np.zeros(len(limit), np.int64), limit.astype(np.int64)
    while (low < high).any():
        middle = (low + high + 1) >> 1
        good = holds(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _repeated(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, by key and place, and a number for each key."""
    if not len(at):
        return at, at
    order = np.argsort(keys)
    keys, at = keys[order], at[order]
    equal = np.concatenate(([False], keys[1:] == keys[:-1], [False]))
    kept = equal[1:] | equal[:-1]
    keys, at = keys[kept], at[kept]
    order = np.lexsort((at, keys))
    keys, at = keys[order], at[order]
    return at, np.cumsum(np.concatenate(([False], keys[1:] != keys[:-1]))[: len(at)])


def _pairs(at: np.ndarray, group: np.ndarray, seed: np.ndarray, n: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` for two places of a group that are ``low`` to ``high - 1`` apart and of which one is a seed."""
    where = group * (n + 1) + at
    seeds = np.flatnonzero(seed)
    base, x = group[seeds] * (n + 1), at[seeds]
    out = []
    for a, b, other in (
        (np.minimum(x + low, n), np.minimum(x + high, n), None),
        (np.maximum(x - high + 1, 0), np.maximum(x - low + 1, 0), ~seed),  # two seeds have met from the left one
    ):
        first, last = np.searchsorted(where, base + a), np.searchsorted(where, base + b)
        count = np.maximum(last - first, 0)
        partner = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        mine, theirs = np.repeat(x, count), at[partner]
        if other is not None:
            mine, theirs = mine[other[partner]], theirs[other[partner]]
        out.append((np.minimum(mine, theirs), np.abs(theirs - mine)))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def find_runs(codes: np.ndarray, starts: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs of all texts, by start and period; starts count from the first text's.

    A run is a maximal stretch with smallest period ``q`` and at least
    ``max(least, 2q)`` words.
    """
    n = len(codes)
    lengths = np.diff(starts)
    none = np.zeros(0, np.int64)
    if not n or lengths.max() < least:
        return none, none, none
    doc = np.repeat(np.arange(len(lengths)), lengths)
    begin, stop = starts[doc], starts[doc + 1]
    hashes = _Hashes(codes)
    found = (none, none, none)
    k = first_k = max(1, least // 2 + least % 2)
    at = np.arange(n)
    while len(at) and k <= max(lengths.max() // 2, first_k):
        at = at[at + k <= stop[at]]
        at, group = _repeated(mix(hashes.grams(at, k) ^ mix(doc[at].astype(np.uint64))), at)
        if not len(at):
            break
        seed = np.ones(len(at), bool)
        if k > first_k:
            known = (found[1] >= k) & (2 * found[2] <= k)
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, found[0][known], 1)
            np.add.at(change, found[0][known] + found[1][known] - k + 1, -1)
            inner = np.cumsum(change[:n]) > 0
            inner[found[0][known]] = False
            seed = ~inner[at]
        place, lag = _pairs(at, group, seed, n, k if k > first_k else 1, 2 * k)
        if len(place):
            order = np.lexsort((place, lag))
            place, lag = place[order], lag[order]
            # A pair of the same lag covers the k words from its place on.
            behind = (lag[1:] == lag[:-1]) & (place[1:] <= place[:-1] + k)
            left = place[np.concatenate(([True], ~behind))]
            right = place[np.concatenate((~behind, [True]))] + k
            lag = lag[np.concatenate(([True], ~behind))]
            grown = _most(lambda m: hashes.same(left - m, lag, m), left - begin[left])
            start = left - grown
            limit = stop[left] - lag - right
            end = right + _most(lambda m: hashes.same(right, lag, m), limit)
            length = end - start + lag
            good = length >= np.maximum(least, 2 * lag)
            found = tuple(np.concatenate((f, new[good])) for f, new in zip(found, (start, length, lag), strict=True))
            # Multiples of a period cover the same stretch: the smallest stands.
            order = np.lexsort((found[2], found[1], found[0]))
            found = tuple(f[order] for f in found)
            once = np.concatenate(([True], (np.diff(found[0]) != 0) | (np.diff(found[1]) != 0)))[: len(order)]
            found = tuple(f[once] for f in found)
        k *= 2
    order = np.lexsort((found[2], found[0]))
    return tuple(f[order] for f in found)


def _collapsed(texts: Texts, kept: np.ndarray) -> pa.Array:
    """Every text's kept words, joined by one space."""
    words = np.flatnonzero(kept)
    size = texts.size[words] + 1
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    raw = np.append(texts.raw, np.uint8(32))
    out = raw[np.arange(total) + np.repeat(texts.first[words] - (ends - size), size)]
    out[ends - 1] = 32
    # Without the space after a text's last word.
    per_text = np.searchsorted(words, texts.starts)
    bounds = np.concatenate(([0], ends))[per_text]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    keep = np.ones(total, bool)
    keep[last] = False
    offsets = bounds - np.concatenate(([0], np.cumsum(np.diff(bounds) > 0)))
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[keep])])


def with_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row's text.

    ``runs`` lists ``start``, ``length`` and ``period`` in words, by start and
    then period; ``collapsed`` is the text without the words that repeat what a
    run has said: of each run its first period stays, unless another run drops
    it. Words are ``[^\\x20\\x09-\\x0D]+``, as they are written, and ``collapsed``
    joins them by single spaces. A null or empty text has no words, no runs and
    an empty ``collapsed``. Every row is by itself: repeated and null ids and
    further columns do not matter. One text is worked on as a whole, in memory
    proportional to its length.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = Texts.of(part.column("text"))
                start, length, period = find_runs(texts.codes, texts.starts, least)
                doc = np.searchsorted(texts.starts, start, side="right") - 1
                change = np.zeros(len(texts.codes) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                kept = np.cumsum(change[:-1]) == 0
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(start - texts.starts[doc]), pa.array(length), pa.array(period)], fields=list(run))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(texts.starts)), pa.ListArray.from_arrays(pa.array(bounds), values), _collapsed(texts, kept).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(work, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` in which a tenth of the texts, chosen by a checksum of the id, repeats from some word on.

    With ``h`` the CRC-32 of the id in decimal, ``g = h div 10`` and ``n`` words,
    a text with ``h % 10 = 0`` has ``a = g % n`` words as they were, and then its
    next ``1 + (n - a) div (3 + g % 8)`` words over and over. A null id plants nothing.
    """
    text = F.col("text")
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = out.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    out = out.withColumn("w", F.when(chosen, words)).withColumn("n", F.size("w"))
    out = out.withColumn("a", F.when(F.col("n") > 0, F.expr("(h div 10) % n")))
    out = out.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1L), i -> element_at(w, cast(1 + if(i < a, i, a + (i - a) % p) AS INT))), ' ')")
    return out.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(text).alias("text"))
