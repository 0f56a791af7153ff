"""Row de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import (
    column_list,
    comparable,
    fresh_name,
    holds_type,
    quoted,
    require_columns,
)


def drop_duplicate_rows(
    df: DataFrame, keys: str | list[str] | None = None, copies: str | None = None
) -> DataFrame:
    """One row per distinct row (or per distinct ``keys``); nulls compare equal.

    Runs as a hash aggregate, so copies collapse inside each map task before
    the shuffle and a row repeated a billion times sends one row per task.
    Map and variant columns, which Spark refuses to group, are grouped through
    an order-free stand-in. ``copies`` names an extra column with the number
    of input rows behind each output row.
    """
    chosen = column_list(keys) or df.columns
    require_columns(df, chosen, "the frame to de-duplicate")
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    awkward = [
        name for name in chosen if holds_type(types[name.lower()], (T.MapType, T.VariantType))
    ]
    if not awkward and copies is None:
        return df.dropDuplicates(None if keys is None else chosen)

    if not awkward and keys is None:
        return df.groupBy(*[quoted(c) for c in chosen]).agg(F.count(F.lit(1)).alias(copies))

    stand_ins = {}
    for name in awkward:
        stand_ins[fresh_name(df, f"__same_{name}")] = comparable(
            quoted(name), types[name.lower()]
        )
    grouped = [quoted(c) for c in chosen if c not in awkward] + [quoted(c) for c in stand_ins]
    if copies is None:
        names = [c for c in chosen if c not in awkward] + list(stand_ins)
        return df.withColumns(stand_ins).dropDuplicates(names).drop(*stand_ins)

    row = fresh_name(df, "__row")
    counted = (
        df.withColumns(stand_ins)
        .groupBy(*grouped)
        .agg(
            F.first(F.struct(*[quoted(c) for c in df.columns])).alias(row),
            F.count(F.lit(1)).alias(copies),
        )
    )
    return counted.select(*[F.col(row)[c].alias(c) for c in df.columns], quoted(copies))


def latest_per_key(df: DataFrame, keys: str | list[str], recency: str) -> DataFrame:
    """The newest row of every key; rows with a null key part are all kept.

    An aggregate rather than a ranking window: each map task keeps one
    candidate per key, so a key with a third of the rows never lands in one
    task. Ties on ``recency`` fall to the greatest remaining values, which
    makes the choice independent of task order.
    """
    keys = column_list(keys)
    require_columns(df, [*keys, recency], "the batch")
    types = {f.name: f.dataType for f in df.schema.fields}
    order = F.struct(
        quoted(recency).alias("__recency"),
        *[comparable(quoted(c), types[c]).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    row = fresh_name(df, "__row")
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & quoted(key).isNotNull()
    newest = (
        df.where(has_key)
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.max_by(F.struct(*[quoted(c) for c in df.columns]), order).alias(row))
        .select(*[F.col(row)[c].alias(c) for c in df.columns])
    )
    return newest.unionByName(df.where(~has_key))
