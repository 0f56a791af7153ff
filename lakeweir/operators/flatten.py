"""Turn nested columns into scalar ones, deciding from the schema alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import column_list, quoted, require_columns, require_distinct_names


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Replace a JSON text column by the struct it holds."""
    require_columns(df, [column], "the frame")
    return df.withColumn(column, F.from_json(quoted(column), schema))


def _open_structs(df: DataFrame, sep: str) -> DataFrame:
    """Replace every top-level struct by one column per field."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [
                quoted(field.name)[child.name].alias(f"{field.name}{sep}{child.name}")
                for child in field.dataType.fields
            ]
        else:
            columns.append(quoted(field.name))
    names = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            names += [f"{field.name}{sep}{child.name}" for child in field.dataType.fields]
        else:
            names.append(field.name)
    require_distinct_names(names, "flattening")
    return df.select(*columns)


def _explode(df: DataFrame, field: T.StructField, sep: str) -> DataFrame:
    """One row per element; rows with a null or empty collection stay, as null."""
    columns = []
    for other in df.schema.fields:
        if other.name != field.name:
            columns.append(quoted(other.name))
        elif isinstance(field.dataType, T.MapType):
            columns.append(
                F.explode_outer(quoted(field.name)).alias(
                    f"{field.name}{sep}key", f"{field.name}{sep}value"
                )
            )
        else:
            columns.append(F.explode_outer(quoted(field.name)).alias(field.name))
    exploded = df.select(*columns)
    require_distinct_names(exploded.columns, "flattening")
    return exploded


def flatten(
    df: DataFrame,
    sep: str = "_",
    explode: bool = True,
    explode_columns: str | list[str] | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """Flatten structs to ``parent<sep>child`` columns and arrays to rows.

    Two sibling arrays would multiply each other's rows, so they raise unless
    ``explode_columns`` says which flattened names to explode; arrays outside
    that list, and all maps outside it, stay as they are. ``max_depth`` bounds
    the number of levels that are opened.
    """
    listed = None if explode_columns is None else column_list(explode_columns)
    depth = 0
    while max_depth is None or depth < max_depth:
        fields = df.schema.fields
        if any(isinstance(f.dataType, T.StructType) for f in fields):
            df = _open_structs(df, sep)
            depth += 1
            continue
        if not explode:
            break
        arrays = [
            f
            for f in fields
            if (isinstance(f.dataType, T.ArrayType) and (listed is None or f.name in listed))
            or (isinstance(f.dataType, T.MapType) and listed is not None and f.name in listed)
        ]
        if not arrays:
            break
        if listed is None and len(arrays) > 1:
            raise ValueError(
                f"arrays {[f.name for f in arrays]} are siblings and would multiply rows; "
                "name the ones to explode in explode_columns"
            )
        df = _explode(df, arrays[0], sep)
        depth += 1
    return df
