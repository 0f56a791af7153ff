"""Report on strings longer than the warehouse allows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import quoted

MAX_STRING_LENGTH = 4000  # fixed value: bound of every string the warehouse takes


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def exceeds_bound(df: DataFrame, max_len: int | None = MAX_STRING_LENGTH) -> Column:
    """Whether any string of the row has more than ``max_len`` characters."""
    if max_len is None:
        return F.lit(False)
    tests = [F.coalesce(F.length(quoted(c)) > max_len, F.lit(False)) for c in _string_columns(df)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def overlong_rows(df: DataFrame, max_len: int = MAX_STRING_LENGTH) -> DataFrame:
    """Rows with at least one string of more than ``max_len`` characters."""
    return df.where(exceeds_bound(df, max_len))


def string_bound_report(df: DataFrame, max_len: int = MAX_STRING_LENGTH) -> DataFrame:
    """One row per string column: rows over the bound, and the longest value.

    All columns are measured in one pass; only the single row of totals is
    turned into a row per column.
    """
    names = _string_columns(df)
    if not names:
        raise ValueError("the frame has no string column to measure")
    totals = []
    for i, name in enumerate(names):
        totals.append(F.count_if(F.length(quoted(name)) > max_len).alias(f"over_{i}"))
        totals.append(F.max(F.length(quoted(name))).alias(f"longest_{i}"))
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"over_{i}").alias("rows_over"),
            F.col(f"longest_{i}").alias("longest"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*totals).select(F.inline(F.array(*lines)))
