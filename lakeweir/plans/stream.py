"""Incremental load: file stream to a registered lake table."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from lakeweir.functions.columns import blank_to_none, column_list
from lakeweir.operators.names import strip_column_spaces
from lakeweir.plans.batch import MERGES, LoadResult
from lakeweir.sources.files import available_format
from lakeweir.sources.history import record_load
from lakeweir.sources.tables import register_table
from lakeweir.streaming.schemas import evolve_schema
from lakeweir.streaming.streams import (
    append_stream,
    file_stream,
    merged_increments,
    validated_append,
)


@dataclass
class StreamSpec:
    """Parameters of one incremental load.

    ``target_schema`` turns on validation of each increment; values are then
    read as text by default, so that one that does not fit is seen and reported
    rather than nulled by the reader. Without it the stream's own schema, which
    may gain columns between runs, is the table's.

    ``merge`` (``newest`` or ``soft``) merges each increment into ``table`` by ``keys``
    instead of appending it; the versions of the table then live under ``path``.
    """

    source: str
    fmt: str
    path: str
    checkpoint: str
    merge: str | None = None
    keys: str | list[str] | None = None
    recency: str | None = None
    dedupe_batch: bool = False
    partition_by: str | list[str] | None = None
    schema_path: str | None = None
    schema: T.StructType | str | None = None
    table: str | None = None
    multiline: bool = False
    recursive: bool = True
    infer_types: bool | None = None
    header: bool = True
    sep: str | None = None
    max_files: int | None = 1000
    corrupt_column: str | None = None
    options: Mapping[str, str] | None = None
    sink_format: str = "parquet"
    target_schema: T.StructType | None = None
    on_extra: str = "drop"
    reject_path: str | None = None
    dedupe: bool = False
    history_root: str | None = None
    batch_id: str = field(default_factory=lambda: uuid.uuid4().hex)


def _sync_table(spark: SparkSession, spec: StreamSpec, schema: T.StructType) -> None:
    """Register the table, or add the columns it has gained since."""
    # Increment directories are storage detail, not a column of the table.
    options = {"recursiveFileLookup": "true"} if spec.target_schema is not None else None
    if not spark.catalog.tableExists(spec.table):
        register_table(
            spark, spec.table, spec.path, schema, fmt=spec.sink_format, options=options
        )
        return
    known = {c.lower() for c in spark.table(spec.table).columns}
    added = [f for f in schema.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {spec.table} ADD COLUMNS ({columns})")
    spark.catalog.refreshTable(spec.table)


class _RowsRead(StreamingQueryListener):
    """A running total of the rows of one run, whatever the number of its increments."""

    def __init__(self):
        self.rows, self.ended = Counter(), threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.set()


def _check(spec: StreamSpec) -> None:
    """Reject combinations that would quietly do nothing."""
    if spec.merge is None:
        if column_list(spec.keys):
            raise ValueError("key columns are set but no merge is chosen")
        return
    if spec.merge not in MERGES:
        raise ValueError(f"merge must be one of {MERGES}, not {spec.merge!r}")
    if not spec.table or not column_list(spec.keys):
        raise ValueError("a merging stream needs a table and key columns")
    if spec.dedupe_batch and not blank_to_none(spec.recency):
        raise ValueError("dedupe_batch needs a recency column")
    if spec.dedupe:
        raise ValueError("a merging stream reduces its increments with dedupe_batch")


@contextmanager
def _rows_read(spark: SparkSession):
    """Counts while streams run; events come in order, so the end is the last of them."""
    listener = _RowsRead()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def ingest_stream(spark: SparkSession, spec: StreamSpec) -> LoadResult:
    """Load what has arrived since the last run and register the table.

    A rerun on the same checkpoint adds nothing twice. Rows are not compared
    across increments: that would need state that grows for ever.
    """
    _check(spec)
    fmt = available_format(spark, spec.sink_format)
    infer_types = spec.infer_types
    if infer_types is None:
        infer_types = spec.target_schema is None or spec.fmt not in ("csv", "json")
    reading = {
        "multiline": spec.multiline,
        "recursive": spec.recursive,
        "infer_types": infer_types,
        "header": spec.header,
        "sep": spec.sep,
        "options": spec.options,
    }
    schema = spec.schema
    if schema is None:
        if spec.schema_path is None:
            raise ValueError("give a schema, or a schema_path to keep the inferred one")
        schema = evolve_schema(spark, spec.source, spec.fmt, spec.schema_path, **reading)
    stream = file_stream(
        spark,
        spec.source,
        spec.fmt,
        schema=schema,
        max_files=spec.max_files,
        corrupt_column=spec.corrupt_column,
        **reading,
    )
    on_batch, totals = None, {}
    if spec.merge is not None:
        on_batch = merged_increments(
            spec.table,
            spec.path,
            spec.keys,
            blank_to_none(spec.recency),
            soft=spec.merge == "soft",
            dedupe_batch=spec.dedupe_batch,
            target=spec.target_schema,
            reject_path=spec.reject_path,
            history_root=spec.history_root,
            load_id=spec.batch_id,
            on_extra=spec.on_extra,
            partition_by=spec.partition_by,
            totals=totals,
        )
    elif spec.target_schema is not None:
        on_batch = validated_append(
            spec.path,
            spec.target_schema,
            reject_path=spec.reject_path,
            history_root=spec.history_root,
            load_id=spec.batch_id,
            dedupe=spec.dedupe,
            on_extra=spec.on_extra,
            fmt=fmt,
            totals=totals,
        )
    with _rows_read(spark) as listener:
        query = append_stream(stream, spec.path, spec.checkpoint, on_batch, fmt=fmt)
        listener.ended.wait(60)
        loaded = listener.rows[str(query.runId)]
    rejected = 0
    if on_batch is not None:
        loaded = sum(rows for rows, _ in totals.values())
        rejected = sum(bad for _, bad in totals.values())
    if spec.table and spec.merge is None:
        _sync_table(spark, spec, spec.target_schema or strip_column_spaces(stream).schema)
    result = LoadResult(
        batch_id=spec.batch_id,
        operation="stream append" if spec.merge is None else "stream merge",
        raw_count=loaded,
        source_count=loaded,
        transform_count=loaded - rejected,
        reject_count=rejected,
    )
    if spec.history_root and on_batch is None:
        record_load(
            spark,
            spec.history_root,
            spec.batch_id,
            result.operation,
            spec.table or spec.path,
            raw_count=loaded,
            source_count=loaded,
            transform_count=loaded,
            rows_out=loaded,
        )
    return result


def table_count(spark: SparkSession, table: str) -> DataFrame:
    """Row count of a table as a one-row frame."""
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows"))
