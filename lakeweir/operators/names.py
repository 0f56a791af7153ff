"""Column-name clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeweir.functions.columns import require_distinct_names


def strip_column_spaces(df: DataFrame) -> DataFrame:
    """Remove spaces from all column names in one projection.

    Raises when two names would become the same. Works on streams as well.
    """
    names = [name.replace(" ", "") for name in df.columns]
    require_distinct_names(names, "removing spaces from column names")
    return df.toDF(*names)
