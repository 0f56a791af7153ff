"""How rows are spread over files before a write.

Hash layouts use the REBALANCE hint, so adaptive execution merges small
partitions and splits large ones: rows of one key sit together until the key
outgrows a partition. Range layouts break ties with a hash of the row and of
the map task, so a value with a third of the rows spans several files while
each file still covers a narrow range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import (
    column_list,
    fresh_name,
    holds_type,
    quoted,
    require_columns,
)


def preview(df: DataFrame, rows: int = 1) -> DataFrame:
    """The first rows Spark comes across, to look at or to make an empty shell from."""
    return df.limit(rows)


def hash_layout(
    df: DataFrame, columns: str | list[str], partitions: int | None = None
) -> DataFrame:
    """Bring rows with equal ``columns`` together, splitting oversized groups."""
    columns = column_list(columns)
    require_columns(df, columns, "the frame")
    escaped = ["`" + c.replace("`", "``") + "`" for c in columns]
    return df.hint("rebalance", *([partitions] if partitions else []), *escaped)


def even_layout(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, whatever they hold."""
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def range_layout(
    df: DataFrame, columns: str | list[str], partitions: int | None = None
) -> DataFrame:
    """Disjoint, sorted ranges of ``columns``, so file statistics can skip files.

    Spark samples the frame for the range bounds, so its plan runs twice;
    stage a frame that is costly to compute.
    """
    columns = column_list(columns)
    require_columns(df, columns, "the frame")
    # The partition id of a map task does not change when the task is retried,
    # unlike a random or running number.
    hashable = [
        quoted(f.name)
        for f in df.schema.fields
        if not holds_type(f.dataType, (T.MapType, T.VariantType))
    ]
    tie = fresh_name(df, "__tie")
    keys = [quoted(c) for c in columns]
    spread = [*keys, quoted(tie)]
    tied = df.withColumn(tie, F.xxhash64(*hashable, F.spark_partition_id()))
    ranged = (
        tied.repartitionByRange(partitions, *spread)
        if partitions
        else tied.repartitionByRange(*spread)
    )
    return ranged.drop(tie).sortWithinPartitions(*keys)
