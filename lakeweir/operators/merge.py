"""Merging a batch into a target by key.

Every merge is DataFrame in, DataFrame out; publishing the result is the
caller's business. Comparisons follow SQL: a null key matches nothing and a
null recency is neither newer nor older, so such rows stay on both sides.

Shape of the plans
------------------
* The side a row is tested against is first reduced to one row per key (its
  greatest recency). Partial aggregation does that inside the map tasks, so a
  key with a third of the rows shrinks before it is shuffled, and duplicate
  keys cannot multiply a join.
* The rows themselves are always the left side of an anti, semi or left outer
  join, where adaptive execution may split an oversized partition. It does so
  only when both sides of the join arrive straight from their own exchange and
  nothing above relies on the join's partitioning, which the aggregations
  before and after the join would do. These joins therefore also compare a
  hash of the key: it changes no match, but the small side is exchanged once
  more and a hot key of the large side can be split over many tasks.
* Nothing is hinted to broadcast. Spark broadcasts a reduced side when its
  size (estimated, or measured at run time) is below
  ``spark.sql.autoBroadcastJoinThreshold``, and then the target is not
  shuffled at all.
* ``sift=True`` sets apart, in the stage of the scan, the target rows whose key
  no batch row has (see :mod:`lakeweir.operators.sieve`). They go straight to
  the result; only the others are joined. For batches too large to broadcast
  that touch a small part of the target: it is then scanned twice and most of
  it is not shuffled.
* ``colocated=True`` leaves the hash out where whole target rows are joined: a
  target bucketed by the keys is then not shuffled either. A bucket is read by
  one task, so this is for keys without hot values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.functions.columns import column_list, fresh_name, quoted, require_columns
from lakeweir.operators.dedupe import latest_per_key
from lakeweir.operators.sieve import split_by_keys

ACTIVE_FLAG = "ELT_ActiveFlag"  # fixed value: flag column of the history-keeping merge

_MOMENT = "__moment"


def _keys_equal(keys: list[str]) -> Column:
    condition = quoted(keys[0], "rows") == quoted(keys[0], "bounds")
    for key in keys[1:]:
        condition = condition & (quoted(key, "rows") == quoted(key, "bounds"))
    return condition


def _splittable(keys: list[str]) -> Column:
    """Key equality in a form that lets a hot key be split (see module)."""
    return _keys_equal(keys) & (
        F.hash(*[quoted(k, "rows") for k in keys])
        == F.hash(*[quoted(k, "bounds") for k in keys])
    )


def _target_match(keys: list[str], colocated: bool) -> Column:
    return _keys_equal(keys) if colocated else _splittable(keys)


def _all_present(columns: list[str]) -> Column:
    condition = quoted(columns[0]).isNotNull()
    for name in columns[1:]:
        condition = condition & quoted(name).isNotNull()
    return condition


def _distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(_all_present(keys)).select(*[quoted(k) for k in keys]).distinct()


def _greatest(df: DataFrame, keys: list[str], recency: str) -> DataFrame:
    """Greatest recency per key, for keys and moments that can match at all."""
    return (
        df.where(_all_present([*keys, recency]))
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.max(quoted(recency)).alias(_MOMENT))
    )


def _greatest_among(
    df: DataFrame, keys: list[str], recency: str, batch: DataFrame
) -> DataFrame:
    """As ``_greatest``, for the keys of ``batch`` only.

    The semi-join sits above the reduction on the same keys: Catalyst moves it
    below when the batch keys fit a broadcast, and otherwise the target is
    reduced before it is shuffled.
    """
    return (
        _greatest(df, keys, recency)
        .alias("rows")
        .join(_distinct_keys(batch, keys).alias("bounds"), _keys_equal(keys), "left_semi")
    )


def _check(target: DataFrame, batch: DataFrame, keys, recency) -> tuple[list[str], str | None]:
    keys = column_list(keys)
    if not keys:
        raise ValueError("a merge needs at least one key column")
    recency = recency or None
    wanted = keys + ([recency] if recency else [])
    require_columns(target, wanted, "the target")
    require_columns(batch, wanted, "the batch")
    return keys, recency


def remove_superseded(
    target: DataFrame,
    batch: DataFrame,
    keys: str | list[str],
    recency: str | None = None,
    colocated: bool = False,
) -> DataFrame:
    """Target rows without those that a batch row of the same key replaces.

    With ``recency`` a batch row replaces target rows that are not newer (ties
    go to the batch); without it, any batch row of the key does.
    """
    keys, recency = _check(target, batch, keys, recency)
    condition = _target_match(keys, colocated)
    if recency:
        bounds = _greatest(batch, keys, recency)
        condition = condition & (F.col(f"bounds.{_MOMENT}") >= quoted(recency, "rows"))
    else:
        bounds = _distinct_keys(batch, keys)
    return target.alias("rows").join(bounds.alias("bounds"), condition, "left_anti")


def remove_outdated(
    batch: DataFrame, target: DataFrame, keys: str | list[str], recency: str
) -> DataFrame:
    """Batch rows without those that some target row of the same key is newer than."""
    keys, recency = _check(target, batch, keys, recency)
    bounds = _greatest_among(target, keys, recency, batch)
    condition = _splittable(keys) & (F.col(f"bounds.{_MOMENT}") > quoted(recency, "rows"))
    return batch.alias("rows").join(bounds.alias("bounds"), condition, "left_anti")


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return target.unionByName(batch)


def replace_keys(
    target: DataFrame,
    batch: DataFrame,
    keys: str | list[str],
    colocated: bool = False,
    sift: bool = False,
) -> DataFrame:
    """Batch rows, plus target rows whose key the batch does not mention."""
    if sift:
        keys, _ = _check(target, batch, keys, None)
        near, far = split_by_keys(target, batch, keys)
        return append_rows(far, replace_keys(near, batch, keys, colocated))
    return append_rows(remove_superseded(target, batch, keys, colocated=colocated), batch)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: str | list[str],
    recency: str | None = None,
    dedupe_batch: bool = False,
    colocated: bool = False,
    sift: bool = False,
) -> DataFrame:
    """Newest-wins merge: delete superseded target rows, then insert the batch.

    A batch row is dropped when a target row that *survived the delete* is
    newer. Of a key that the batch has dates for, those survivors are the
    target rows newer than all its batch rows, so per key either all dated
    batch rows go in (duplicates included) or none do. The keys where the
    target leads are therefore found from the same per-key maxima as the
    delete. Rows without a moment are kept on both sides.

    ``dedupe_batch=True`` first keeps only the newest batch row of each key.
    """
    keys, recency = _check(target, batch, keys, recency)
    if sift:
        near, far = split_by_keys(target, batch, keys)
        return append_rows(far, upsert(near, batch, keys, recency, dedupe_batch, colocated))
    if not recency:
        if dedupe_batch:
            raise ValueError("dedupe_batch needs a recency column")
        return replace_keys(target, batch, keys, colocated)

    newest = _greatest(batch, keys, recency)
    ahead = target.select(*[quoted(c) for c in [*keys, recency]]).alias("rows").join(
        newest.alias("bounds"),
        _splittable(keys) & (quoted(recency, "rows") > F.col(f"bounds.{_MOMENT}")),
        "left_semi",
    )
    # The newest row of a key has the greatest moment of all its rows, so the
    # bounds need not wait for the reduction.
    entering = latest_per_key(batch, keys, recency) if dedupe_batch else batch
    incoming = entering.alias("rows").join(
        _distinct_keys(ahead, keys).alias("bounds"),
        _splittable(keys) & quoted(recency, "rows").isNotNull(),
        "left_anti",
    )
    return append_rows(remove_superseded(target, batch, keys, recency, colocated), incoming)


def _flag_matches(
    df: DataFrame, bounds: DataFrame, condition: Column, flag: str
) -> DataFrame:
    """Set ``flag`` to 0 on rows that meet a row of ``bounds``; keep all rows.

    ``bounds`` has one row per key, so the outer join adds no rows.
    """
    hit = fresh_name(df, "__hit")
    flag_type = df.schema[flag].dataType
    joined = df.alias("rows").join(
        bounds.withColumn(hit, F.lit(True)).alias("bounds"), condition, "left_outer"
    )
    cleared = F.when(F.col(f"bounds.{hit}"), F.lit(0).cast(flag_type)).otherwise(
        quoted(flag, "rows")
    )
    return joined.select(
        *[cleared.alias(c) if c == flag else quoted(c, "rows").alias(c) for c in df.columns]
    )


def _flag_name(df: DataFrame, flag: str) -> str:
    return next(c for c in df.columns if c.lower() == flag.lower())


def flag_superseded(
    target: DataFrame,
    batch: DataFrame,
    keys: str | list[str],
    recency: str | None = None,
    flag: str = ACTIVE_FLAG,
    colocated: bool = False,
) -> DataFrame:
    """All target rows, with ``flag`` 0 on those ``remove_superseded`` would drop."""
    keys, recency = _check(target, batch, keys, recency)
    require_columns(target, [flag], "the target")
    condition = _target_match(keys, colocated)
    if recency:
        bounds = _greatest(batch, keys, recency)
        condition = condition & (F.col(f"bounds.{_MOMENT}") >= quoted(recency, "rows"))
    else:
        bounds = _distinct_keys(batch, keys)
    return _flag_matches(target, bounds, condition, _flag_name(target, flag))


def flag_outdated(
    batch: DataFrame,
    target: DataFrame,
    keys: str | list[str],
    recency: str,
    flag: str = ACTIVE_FLAG,
) -> DataFrame:
    """All batch rows, with ``flag`` 0 on those ``remove_outdated`` would drop."""
    keys, recency = _check(target, batch, keys, recency)
    require_columns(batch, [flag], "the batch")
    bounds = _greatest_among(target, keys, recency, batch)
    condition = _splittable(keys) & (F.col(f"bounds.{_MOMENT}") > quoted(recency, "rows"))
    return _flag_matches(batch, bounds, condition, _flag_name(batch, flag))


def upsert_soft(
    target: DataFrame,
    batch: DataFrame,
    keys: str | list[str],
    recency: str | None = None,
    flag: str = ACTIVE_FLAG,
    colocated: bool = False,
    sift: bool = False,
) -> DataFrame:
    """History-keeping merge: superseded rows stay, with ``flag`` set to 0.

    Target rows are flagged where a batch row of the key is at least as new;
    batch rows where any target row of the key, active or not, is newer. All
    rows of both sides are in the result. A batch without the flag column
    enters as active. Without ``recency`` the batch replaces the active rows
    of its keys and itself stays active.
    """
    keys, recency = _check(target, batch, keys, recency)
    require_columns(target, [flag], "the target")
    if sift:
        near, far = split_by_keys(target, batch, keys)
        return append_rows(far, upsert_soft(near, batch, keys, recency, flag, colocated))
    target_flag = _flag_name(target, flag)
    flag_type = target.schema[target_flag].dataType
    if flag.lower() not in {c.lower() for c in batch.columns}:
        batch = batch.withColumn(target_flag, F.lit(1))
    batch_flag = _flag_name(batch, flag)
    batch = batch.withColumn(batch_flag, quoted(batch_flag).cast(flag_type))
    flagged = flag_superseded(target, batch, keys, recency, target_flag, colocated)
    if recency:
        batch = flag_outdated(batch, target, keys, recency, batch_flag)
    return append_rows(flagged, batch)
