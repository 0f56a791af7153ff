"""One audit row per load of a target."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("load_time", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("raw_count", T.LongType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("transform_count", T.LongType()),
        T.StructField("reject_count", T.LongType()),
        T.StructField("rows_out", T.LongType()),
    ]
)

ROW_SCHEMA = T.StructType([T.StructField("load_id", T.StringType()), *HISTORY_SCHEMA.fields])


def target_folder(target: str) -> str:
    """A folder name that no other target has."""
    return f"target={hashlib.sha256(target.encode()).hexdigest()[:16]}"


def record_load(
    spark: SparkSession, root: str, load_id: str, operation: str, target: str, **counts: int | None
) -> None:
    """Add the row of one load; a repeated load of the same target replaces its own row."""
    now = dt.datetime.now(dt.timezone.utc)
    row = {"load_id": load_id, "load_time": now, "operation": operation, "target": target, **counts}
    values = tuple(row.get(f.name) for f in ROW_SCHEMA.fields)
    spark.createDataFrame([values], ROW_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/load_id={load_id}/{target_folder(target)}"
    )


def load_history(spark: SparkSession, root: str) -> DataFrame:
    """All recorded loads, ``load_id`` first."""
    try:
        rows = spark.read.schema(ROW_SCHEMA).option("recursiveFileLookup", True).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ROW_SCHEMA)
    # Rows of earlier versions of this library have their id in the path alone.
    in_path = F.url_decode(F.regexp_extract("_metadata.file_path", "/load_id=([^/]*)/", 1))
    return rows.withColumn("load_id", F.coalesce("load_id", in_path)).select(*ROW_SCHEMA.names)
