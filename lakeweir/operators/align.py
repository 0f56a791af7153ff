"""Bring a batch into the shape of its target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import quoted, require_distinct_names

REJECTED = "rejected_values"

# Type of the report column: the target column and the text that did not fit.
REJECTED_TYPE = "array<struct<column:string,value:string>>"


def _plain(data_type: T.DataType) -> T.DataType:
    """Bounded strings are enforced by the table on write, not by a cast."""
    return T.StringType() if isinstance(data_type, (T.CharType, T.VarcharType)) else data_type


def _same_type(left: T.DataType, right: T.DataType) -> bool:
    return left.simpleString() == right.simpleString()


def _match_columns(df: DataFrame, target: T.StructType, on_extra: str) -> dict[str, T.StructField]:
    """Target name (lower case) -> source field, after checking both sides."""
    if on_extra not in ("drop", "error"):
        raise ValueError(f"on_extra must be 'drop' or 'error', not {on_extra!r}")
    require_distinct_names(df.columns, "aligning a batch")
    source = {f.name.lower(): f for f in df.schema.fields}
    wanted = {f.name.lower() for f in target.fields}
    extra = [f.name for key, f in source.items() if key not in wanted]
    if extra and on_extra == "error":
        raise ValueError(f"columns {extra} are not in the target schema")
    absent = [
        f.name for f in target.fields if f.name.lower() not in source and not f.nullable
    ]
    if absent:
        raise ValueError(f"the target requires columns {absent}, the batch lacks them")
    return source


def casts_can_fail(df: DataFrame, target: T.StructType) -> bool:
    """Whether aligning needs any cast at all; decided from the schemas."""
    source = {f.name.lower(): f.dataType for f in df.schema.fields}
    return any(
        f.name.lower() in source and not _same_type(source[f.name.lower()], _plain(f.dataType))
        for f in target.fields
    )


def _scalar(value: Column, found: T.DataType, wanted: T.DataType, truncate: bool):
    """A cast value, and whether it lost what it stood for."""
    cast = value.try_cast(wanted)
    lost = value.isNotNull() & cast.isNull()
    numbers = isinstance(found, T.NumericType) and isinstance(wanted, T.NumericType)
    moments = isinstance(found, (T.TimestampType, T.TimestampNTZType)) and isinstance(wanted, T.DateType)
    if not truncate and (numbers or moments):
        lost = lost | (cast.isNotNull() & ~cast.try_cast(found).eqNullSafe(value))
    return cast, lost


def _fitted(value: Column, found: T.DataType, wanted: T.DataType, on_extra: str, truncate: bool):
    """``(value as wanted, whether any part of it did not fit)``, at every depth.

    Fields of structs match by name in any case, like columns.
    """
    if _same_type(found, wanted):
        return value, F.lit(False)
    if isinstance(found, T.StructType) and isinstance(wanted, T.StructType):
        known = {f.name.lower(): f for f in found.fields}
        extra = known.keys() - {f.name.lower() for f in wanted.fields}
        if extra and on_extra == "error":
            raise ValueError(f"fields {sorted(extra)} are not in the target schema")
        parts, lost = [], F.lit(False)
        for field in wanted.fields:
            own = known.get(field.name.lower())
            if own is None:
                parts.append(F.lit(None).cast(_plain(field.dataType)).alias(field.name))
                continue
            part, bad = _fitted(
                value.getField(own.name), own.dataType, _plain(field.dataType), on_extra, truncate
            )
            parts.append(part.alias(field.name))
            lost = lost | bad
        return F.when(value.isNotNull(), F.struct(*parts)), value.isNotNull() & lost
    if isinstance(found, T.ArrayType) and isinstance(wanted, T.ArrayType):
        inner = found.elementType, _plain(wanted.elementType), on_extra, truncate
        lost = F.exists(value, lambda x: _fitted(x, *inner)[1])
        return F.transform(value, lambda x: _fitted(x, *inner)[0]), F.coalesce(lost, F.lit(False))
    if isinstance(found, T.MapType) and isinstance(wanted, T.MapType) and _same_type(
        found.keyType, wanted.keyType
    ):
        inner = found.valueType, _plain(wanted.valueType), on_extra, truncate
        lost = F.exists(F.map_values(value), lambda x: _fitted(x, *inner)[1])
        return (
            F.transform_values(value, lambda _, x: _fitted(x, *inner)[0]),
            F.coalesce(lost, F.lit(False)),
        )
    return _scalar(value, found, wanted, truncate)


def align_with_report(
    df: DataFrame,
    target: T.StructType,
    on_extra: str = "drop",
    report: str = REJECTED,
    truncate: bool = False,
) -> DataFrame:
    """Aligned columns plus a report column listing values that did not fit.

    One projection without a shuffle: names match in any case and at every
    depth, order and types follow ``target``, missing nullable columns and
    fields become null, and each cast is a ``try_cast`` whose failures, inside
    structs, arrays and maps too, are reported (column and original text)
    rather than lost. A number that does not convert back to the same value,
    and a moment that loses its time of day, count as failures unless
    ``truncate`` asks for them. The report is null on rows where every value
    fits.
    """
    source = _match_columns(df, target, on_extra)
    aligned, failures = [], []
    for field in target.fields:
        wanted = _plain(field.dataType)
        found = source.get(field.name.lower())
        if found is None:
            aligned.append(F.lit(None).cast(wanted).alias(field.name))
            continue
        value = quoted(found.name)
        if _same_type(found.dataType, wanted):
            aligned.append(value.alias(field.name))
            continue
        fitted, lost = _fitted(value, found.dataType, wanted, on_extra, truncate)
        aligned.append(fitted.alias(field.name))
        if isinstance(found.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            text = F.to_json(value)
        else:
            text = value.cast("string")
        failures.append(
            F.when(lost, F.struct(F.lit(field.name).alias("column"), text.alias("value")))
        )
    if failures:
        bad = F.array_compact(F.array(*failures))
        rejected = F.when(F.size(bad) > 0, bad)
    else:
        rejected = F.lit(None)
    return df.select(*aligned, rejected.cast(REJECTED_TYPE).alias(report))


def align_schema(
    df: DataFrame,
    target: T.StructType,
    on_extra: str = "drop",
    cast: str = "try",
    truncate: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into rows that fit ``target`` and rows that do not.

    Returns ``(aligned, rejects)``. Every input row is in exactly one of them;
    a rejected row carries the values that did fit and a report of those that
    did not. ``cast="store"`` instead widens only, and raises when a column
    would need more than that.
    """
    if cast == "store":
        source = _match_columns(df, target, on_extra)
        plain = T.StructType(
            [T.StructField(f.name, _plain(f.dataType), f.nullable) for f in target.fields]
        )
        renames = {
            source[f.name.lower()].name: f.name
            for f in target.fields
            if f.name.lower() in source
        }
        aligned = df.withColumnsRenamed(renames).to(plain)
        empty = aligned.withColumn(REJECTED, F.lit(None).cast(REJECTED_TYPE)).where(F.lit(False))
        return aligned, empty
    if cast != "try":
        raise ValueError(f"cast must be 'try' or 'store', not {cast!r}")
    report = align_with_report(df, target, on_extra, truncate=truncate)
    return report.where(F.col(REJECTED).isNull()).drop(REJECTED), report.where(
        F.col(REJECTED).isNotNull()
    )
