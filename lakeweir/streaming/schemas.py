"""Schemas of file streams: inferred once, stored, extended between runs."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import quoted
from lakeweir.sources.files import read_path


def save_schema(
    spark: SparkSession, schema_path: str, schema: T.StructType, seen_until: int | None = None
) -> None:
    """Store a schema as JSON text, with the newest file time it covers.

    Each save adds a numbered file rather than replacing the last one, so a
    failed write cannot lose the schema of a running stream.
    """
    stored = _stored(spark, schema_path)
    number = 0 if stored is None else stored["number"] + 1
    entry = {"number": number, "seen_until": seen_until, "schema": json.loads(schema.json())}
    spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1).write.mode(
        "append"
    ).text(schema_path)


def _stored(spark: SparkSession, schema_path: str) -> dict | None:
    """The newest stored entry, picked by Spark from the entry numbers."""
    try:
        lines = spark.read.text(schema_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    number = F.get_json_object("value", "$.number").cast("int")
    newest = lines.agg(F.max_by("value", number).alias("value")).collect()[0]["value"]
    return None if newest is None else json.loads(newest)


def load_schema(spark: SparkSession, schema_path: str) -> T.StructType | None:
    stored = _stored(spark, schema_path)
    return None if stored is None else T.StructType.fromJson(stored["schema"])


def _newest_file_time(spark: SparkSession, path: str, recursive: bool) -> int | None:
    """Latest modification time under ``path`` in epoch milliseconds; reads no file."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    newest = reader.load(path).agg(F.unix_millis(F.max("modificationTime")).alias("at"))
    return newest.collect()[0]["at"]


def _just_before(moment: int) -> str:
    """One millisecond earlier, in UTC: another file may carry the newest time as well."""
    earlier = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(milliseconds=moment - 1)
    return earlier.replace(tzinfo=None).isoformat(timespec="milliseconds")


def _as_text(schema: T.StructType) -> T.StructType:
    """Every scalar column as a string; nested columns keep their shape."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return T.StructType(
        [
            T.StructField(f.name, f.dataType if isinstance(f.dataType, nested) else T.StringType())
            for f in schema.fields
        ]
    )


# For each number type, those whose every value it can hold.
_HOLDS = {
    "smallint": {"tinyint"},
    "int": {"tinyint", "smallint"},
    "bigint": {"tinyint", "smallint", "int"},
    "double": {"tinyint", "smallint", "int", "float"},
    "timestamp": {"date"},
}


def _merged(stored: T.DataType, fresh: T.DataType, where: str) -> T.DataType:
    if isinstance(stored, T.StructType) and isinstance(fresh, T.StructType):
        known = {f.name.lower() for f in stored.fields}
        new = {f.name.lower(): f.dataType for f in fresh.fields}
        kept = [
            T.StructField(
                f.name,
                _merged(f.dataType, new.get(f.name.lower(), f.dataType), f"{where}.{f.name}"),
                f.nullable,
            )
            for f in stored.fields
        ]
        added = [
            T.StructField(f.name, f.dataType, True)
            for f in fresh.fields
            if f.name.lower() not in known
        ]
        return T.StructType([*kept, *added])
    if isinstance(stored, T.ArrayType) and isinstance(fresh, T.ArrayType):
        inner = _merged(stored.elementType, fresh.elementType, where)
        return T.ArrayType(inner, stored.containsNull)
    old, new = stored.simpleString(), fresh.simpleString()
    # Text holds anything; a column without a value so far is inferred as void or text.
    if old == new or old == "string" or new in ("void", *_HOLDS.get(old, ())):
        return stored
    if new == "string" and isinstance(fresh, T.StringType) and old == "void":
        return fresh
    raise ValueError(
        f"new files bring {new} in {where.lstrip('.')}, which is stored as {old} and would read "
        "as null; store a wider schema, or validate against a target_schema"
    )


def merge_schemas(stored: T.StructType, fresh: T.StructType) -> T.StructType:
    """Stored columns with their types, then new ones as nullable columns.

    Structs gain new fields in the same way, at every depth. New files with
    values that a stored type cannot hold are refused: files that are written
    already keep theirs.
    """
    return _merged(stored, fresh, "")


def _without_blanks(files: DataFrame, known: T.StructType) -> T.StructType:
    """The schema of new files, with the stored type for text in which every value has it.

    A column without values is inferred as text, as is one with values of a
    stored kind that inference does not look for.
    """
    stored = {f.name.lower(): f.dataType for f in known.fields}
    nested = (T.StructType, T.ArrayType, T.MapType, T.StringType)
    doubtful = [
        f.name
        for f in files.schema.fields
        if isinstance(f.dataType, T.StringType)
        and not isinstance(stored.get(f.name.lower(), T.StringType()), nested)
    ]
    if not doubtful:
        return files.schema
    bad = files.agg(
        *[
            F.count_if(
                quoted(c).isNotNull() & quoted(c).try_cast(stored[c.lower()]).isNull()
            ).alias(f"bad{i}")
            for i, c in enumerate(doubtful)
        ]
    ).first()
    fits = {c for i, c in enumerate(doubtful) if not bad[i]}
    return T.StructType(
        [
            T.StructField(f.name, stored[f.name.lower()], True) if f.name in fits else f
            for f in files.schema.fields
        ]
    )


def evolve_schema(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_path: str,
    *,
    multiline: bool = False,
    recursive: bool = True,
    infer_types: bool = True,
    header: bool = True,
    sep: str | None = None,
    options: Mapping[str, str] | None = None,
) -> T.StructType:
    """The schema to start a stream with.

    The first run infers it from the files present and stores it. Later runs
    look only at files that came since, and append the columns they add: a
    restart costs the new files, not the whole history.
    """

    # Files that carry their schema need not all carry the same one.
    merged_files = {"mergeSchema": "true"} if fmt in ("parquet", "orc") else {}

    def infer(extra: dict[str, str]) -> DataFrame:
        return read_path(
            spark,
            path,
            fmt,
            sep=sep,
            header=header,
            multiline=multiline,
            recursive=recursive,
            options={**merged_files, **(options or {}), **extra},
        )

    stored = _stored(spark, schema_path)
    newest = _newest_file_time(spark, path, recursive)
    if stored is None:
        if newest is None:
            raise ValueError(f"no files under {path} to infer a schema from")
        schema = infer({}).schema
        schema = schema if infer_types else _as_text(schema)
        save_schema(spark, schema_path, schema, newest)
        return schema

    known = T.StructType.fromJson(stored["schema"])
    seen = stored["seen_until"]
    if newest is None or (seen is not None and newest < seen):
        return known
    recent = {} if seen is None else {"modifiedAfter": _just_before(seen), "timeZone": "UTC"}
    new_files = infer(recent)
    fresh = _without_blanks(new_files, known)
    merged = merge_schemas(known, fresh if infer_types else _as_text(fresh))
    if merged != known or newest != seen:
        save_schema(spark, schema_path, merged, newest)
    return merged
