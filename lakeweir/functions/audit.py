"""Audit columns that every load carries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the audit columns, in the order they are appended.
INSTANCE_COLUMN = "ELT_TransformInstanceID"
SOURCE_COLUMN = "ELT_SourceFile"
TIME_COLUMN = "ELT_Timestamp"
TENANT_COLUMN = "company_code"

AUDIT_COLUMNS = (TENANT_COLUMN, INSTANCE_COLUMN, SOURCE_COLUMN, TIME_COLUMN)


def add_audit(
    df: DataFrame,
    instance_id: object,
    source: str,
    load_time: dt.datetime | None = None,
    tenant: str | None = None,
    per_file: bool = False,
) -> DataFrame:
    """Append instance id, source path and load time, and a tenant code if given.

    ``load_time`` defaults to the driver clock in whole seconds, so a batch has
    one value even when it is evaluated by several jobs. A blank or malformed
    ``instance_id`` becomes null. ``per_file=True`` records the file each row
    came from instead of the requested path; it needs a frame that comes
    straight from a file scan, since a de-duplicated row has no single file.
    """
    load_time = load_time or dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    origin = F.col("_metadata.file_path") if per_file else F.lit(source)
    columns = {}
    if tenant is not None:
        columns[TENANT_COLUMN] = F.upper(F.lit(tenant))
    instance = None if instance_id is None else str(instance_id)
    columns[INSTANCE_COLUMN] = F.lit(instance).cast("string").try_cast("int")
    columns[SOURCE_COLUMN] = origin
    columns[TIME_COLUMN] = F.lit(load_time).cast("timestamp")
    return df.withColumns(columns)
