"""A map of key hashes that tells, inside the scan, which rows a batch cannot touch.

The map has a fixed size whatever the batch holds. Each row looks up one bit: if
no key of the batch sets it, no key of the batch equals the row's, and the row
needs no join. Others may match, by chance as well, the more of them the fuller
the map: with a million distinct keys about one row in nine of the untouched
ones still takes the join, and a batch of many times that gains nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.functions.columns import column_list, quoted, require_columns

#: Bits of the map: one megabyte, handed to every task.
SIEVE_BITS = 1 << 23
#: Fixed value: bits that one of Spark's bitmap aggregates holds.
_BUCKET_BITS = 32768


def _place(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(bits))


def _present(keys: list[str]) -> Column:
    found = quoted(keys[0]).isNotNull()
    for key in keys[1:]:
        found = found & quoted(key).isNotNull()
    return found


def _words(batch: DataFrame, keys: list[str], bits: int) -> Column:
    """The map as one array of 64-bit words, read once per query."""
    place = _place(keys, bits)
    maps = (
        batch.where(_present(keys))
        .select(place.alias("at"))
        .groupBy(F.expr(f"at div {_BUCKET_BITS}").cast("int").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("at") % _BUCKET_BITS).alias("map"))
    )
    # Eight bytes of a map as a signed number; buckets that no key fell into are zeros.
    word = "cast(conv(hex(substring(map, 8 * w + 1, 8)), 16, -10) AS BIGINT)"
    n_words = _BUCKET_BITS // 64
    words = F.expr(f"transform(sequence(0, {n_words - 1}), w -> {word})").alias("words")
    whole = F.expr(
        f"flatten(transform(sequence(0, {bits // _BUCKET_BITS - 1}), b -> coalesce(words[b], array_repeat(0L, {n_words}))))"
    )
    rows = maps.select("bucket", words)
    return rows.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "words"))).alias("words")).select(whole).scalar()


def may_match(df: DataFrame, batch: DataFrame, keys: str | list[str], bits: int = SIEVE_BITS) -> Column:
    """Whether a row of ``df`` may have a key that ``batch`` has; false is certain.

    A null key matches nothing. The keys must have the same types on both sides,
    as their hashes are compared. ``bits`` is a power of two, 32768 at least.
    """
    keys = column_list(keys)
    if not keys:
        raise ValueError("a map of keys needs at least one key column")
    if bits < _BUCKET_BITS or bits & (bits - 1):
        raise ValueError(f"bits must be a power of two and at least {_BUCKET_BITS}, not {bits}")
    require_columns(df, keys, "the frame")
    require_columns(batch, keys, "the batch")
    for key in keys:
        own, other = (d.select(quoted(key)).schema[0].dataType for d in (df, batch))
        if own != other:
            raise ValueError(f"key {key!r} is {own.simpleString()} here and {other.simpleString()} in the batch")
    place = _place(keys, bits)
    # A word's first byte is its highest.
    bit = (F.lit(56) - F.shiftright(place, 3) % 8 * 8 + place % 8).cast("int")
    word = F.get(_words(batch, keys, bits), F.shiftright(place, 6).cast("int"))
    shifted = F.call_function("shiftright", word, bit)
    return _present(keys) & (shifted.bitwiseAND(F.lit(1).cast("long")) == 1)


def split_by_keys(
    df: DataFrame, batch: DataFrame, keys: str | list[str], bits: int = SIEVE_BITS
) -> tuple[DataFrame, DataFrame]:
    """``(near, far)``: the rows whose key the batch may have, and those whose key it has not.

    Both read ``df``, with the test in the stage of the scan.
    """
    near = may_match(df, batch, keys, bits)
    return df.where(near), df.where(~near)
