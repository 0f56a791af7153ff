"""JSON text whose schema nobody gives: found in one pass, kept, and read by."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import fresh_name, quoted, require_columns, require_distinct_names
from lakeweir.streaming.schemas import load_schema, save_schema


def _readable(kind: T.DataType) -> T.DataType:
    """A type that values can be read at: what was only ever null or empty is text."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _readable(f.dataType)) for f in kind.fields]
        return T.StructType(fields) if fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def infer_json_schema(df: DataFrame, column: str) -> T.StructType:
    """The merged schema of the JSON objects in a text column, from one pass over all rows.

    Fields come by name. A field whose values have no common type, or that is
    null wherever it occurs, is text. Values that are no objects, or no JSON,
    say nothing. Without any object the schema is empty.
    """
    require_columns(df, [column], "the frame")
    value = F.try_parse_json(quoted(column))
    objects = F.when(F.schema_of_variant(value).startswith("OBJECT<"), value)
    found = df.select(F.schema_of_variant_agg(objects)).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType()
    # Names in backticks stay as they are.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    ddl = "".join(p if p.startswith("`") else re.sub(r"\bOBJECT<", "STRUCT<", p) for p in parts)
    return _readable(T.DataType.fromDDL(ddl))


def open_json(
    df: DataFrame, column: str, schema_path: str | None = None, rest: str | None = None
) -> DataFrame:
    """Replace a JSON text column by the struct it holds, without being told the schema.

    The schema is found in one pass. With ``schema_path`` it is stored there,
    and later runs read by the stored one without that pass. What a row holds
    beyond it is kept in the text column ``rest`` (``<column>_rest``), null where
    nothing is left: as an object of the fields that the schema lacks or whose
    values its types cannot hold, and as the text itself where that is no
    object. Fields are compared at the top level of the object; a misfit inside
    one is read as null there. An empty schema leaves all in ``rest``.
    """
    require_columns(df, [column], "the frame")
    rest = rest or f"{column}_rest"
    require_distinct_names([*df.columns, rest], "opening JSON")
    schema = load_schema(df.sparkSession, schema_path) if schema_path else None
    if schema is None:
        schema = infer_json_schema(df, column)
        if schema_path and schema.fields:
            save_schema(df.sparkSession, schema_path, schema)
    text, parsed = quoted(column), fresh_name(df, "__parsed")
    value = F.try_parse_json(text)
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    left = lambda k, v: F.lit(True)
    if schema.fields:
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        # The names of fields that were not read, so that the filter below looks up names only.
        missing = F.array_compact(
            F.array(*[F.when(quoted(parsed)[f.name].isNull(), F.lit(f.name)) for f in schema.fields])
        )
        left = lambda k, v: ~F.array_contains(known, k) | (
            F.array_contains(missing, k) & ~F.is_variant_null(v)
        )
        df = df.withColumn(parsed, F.from_json(text, schema))
    over = F.map_filter(fields, left)
    kept = F.when(fields.isNull(), text).when(F.size(over) > 0, F.to_json(over)).alias(rest)
    columns = [
        quoted(parsed).alias(c) if c.lower() == column.lower() and schema.fields else quoted(c)
        for c in df.columns
        if c != parsed and (schema.fields or c.lower() != column.lower())
    ]
    return df.select(*columns, kept)
