"""Small helpers around column names and values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_list(columns: str | Iterable[str] | None) -> list[str]:
    """Column names from a list or from one pipe-separated string."""
    if columns is None:
        return []
    if isinstance(columns, str):
        columns = columns.split("|")
    return [name.strip() for name in columns if name and name.strip()]


def truthy(flag: object) -> bool:
    """Read a job parameter as a boolean: ``1`` and ``true`` in any case."""
    return str(flag).strip().lower() in ("1", "true")


def blank_to_none(text: str | None) -> str | None:
    """Job parameters use the empty string for "not set"."""
    return text if text else None


def quoted(name: str, alias: str | None = None) -> Column:
    """Reference to a column whose name may hold dots, spaces or backticks."""
    escaped = "`" + name.replace("`", "``") + "`"
    return F.col(f"{alias}.{escaped}" if alias else escaped)


def require_columns(df: DataFrame, columns: Sequence[str], where: str) -> None:
    """Fail on the driver, before any job, when a named column is missing."""
    known = {name.lower() for name in df.columns}
    missing = [name for name in columns if name.lower() not in known]
    if missing:
        raise ValueError(f"{where} has no column {missing}; it has {df.columns}")


def require_distinct_names(names: Sequence[str], what: str) -> None:
    """Spark only notices clashing names when a later step refers to them."""
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"{what}: {seen[name.lower()]!r} and {name!r} would share a name")
        seen[name.lower()] = name


def fresh_name(df: DataFrame, stem: str) -> str:
    """A helper column name that no column of ``df`` uses."""
    taken = {name.lower() for name in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def holds_type(data_type: T.DataType, kinds: tuple[type, ...]) -> bool:
    """Whether ``data_type`` is one of ``kinds`` or contains one at any depth."""
    if isinstance(data_type, kinds):
        return True
    if isinstance(data_type, T.StructType):
        return any(holds_type(f.dataType, kinds) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return holds_type(data_type.elementType, kinds)
    if isinstance(data_type, T.MapType):
        return holds_type(data_type.keyType, kinds) or holds_type(data_type.valueType, kinds)
    return False


def comparable(value: Column, data_type: T.DataType) -> Column:
    """A value that groups equal exactly when ``value`` holds the same data.

    Spark cannot group maps and variants. A map becomes its sorted entries and
    a variant its JSON text; other types pass through unchanged.
    """
    if not holds_type(data_type, (T.MapType, T.VariantType)):
        return value
    if isinstance(data_type, T.VariantType):
        return F.to_json(value)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: comparable(item, data_type.elementType))
    if isinstance(data_type, T.MapType):
        entries = F.map_entries(value)
        if holds_type(data_type.valueType, (T.MapType, T.VariantType)):
            entries = F.transform(
                entries,
                lambda entry: F.struct(
                    entry["key"].alias("key"),
                    comparable(entry["value"], data_type.valueType).alias("value"),
                ),
            )
        return F.sort_array(entries)
    fields = [comparable(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
    return F.when(value.isNotNull(), F.struct(*fields))
