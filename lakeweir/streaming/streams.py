"""File streams in, append-only files out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeweir.functions.columns import blank_to_none, column_list
from lakeweir.operators.align import REJECTED, REJECTED_TYPE, align_with_report
from lakeweir.operators.dedupe import drop_duplicate_rows, latest_per_key
from lakeweir.operators.merge import ACTIVE_FLAG, upsert, upsert_soft
from lakeweir.operators.names import strip_column_spaces
from lakeweir.sources.history import record_load
from lakeweir.sources.staging import release, stage
from lakeweir.sources.tables import has_batch, partition_columns, publish
from lakeweir.streaming.schemas import evolve_schema


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema_path: str | None = None,
    *,
    schema: T.StructType | str | None = None,
    recursive: bool = True,
    multiline: bool = False,
    infer_types: bool = True,
    header: bool = True,
    sep: str | None = None,
    max_files: int | None = 1000,
    corrupt_column: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of the files under ``path``, each read once.

    The schema is given, or inferred and kept at ``schema_path``. Directories
    that are not ``column=value`` are only entered with ``recursive``.
    ``max_files`` bounds one increment (None: no bound), so a large backlog commits in steps
    instead of one job that starts over when it fails. CSV and JSON records
    that do not fit the schema lose the values in question; with
    ``corrupt_column`` their whole text is kept in that column.
    """
    if schema is None:
        if schema_path is None:
            raise ValueError("give a schema, or a schema_path to keep the inferred one")
        schema = evolve_schema(
            spark,
            path,
            fmt,
            schema_path,
            multiline=multiline,
            recursive=recursive,
            infer_types=infer_types,
            header=header,
            sep=sep,
            options=options,
        )
    reader = spark.readStream.format(fmt)
    if corrupt_column is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    reader = reader.schema(schema)
    reader = reader.option("recursiveFileLookup", recursive)
    if fmt in ("csv", "json"):
        reader = reader.option("multiLine", multiline)
    if fmt == "csv":
        reader = reader.option("header", header)
        if header:
            # Columns are read by position: refuse a file whose header names others.
            reader = reader.option("enforceSchema", False)
        sep = blank_to_none(sep)
        if sep is not None:
            reader = reader.option("sep", sep)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**(options or {})).load(path)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    *,
    fmt: str = "parquet",
    clean_names: bool = True,
) -> StreamingQuery:
    """Append everything not yet loaded to ``path``, then stop.

    Progress is kept in ``checkpoint``: a further run takes only new files.
    With ``on_batch`` that function writes each increment instead; it may see
    the same increment again after a failure. Returns the finished query, and
    raises what the query failed with.
    """
    if clean_names:
        stream = strip_column_spaces(stream)
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if on_batch is None:
        query = writer.format(fmt).start(path)
    else:
        query = writer.foreachBatch(on_batch).start()
    query.awaitTermination()
    return query


@contextmanager
def _checked_increment(
    increment: DataFrame,
    batch_id: int,
    target: T.StructType | None,
    *,
    reject_path: str | None,
    load_id: str,
    on_extra: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
):
    """One evaluation of an increment, with misfits moved away and rows counted.

    Gives ``(good rows, rows, rejected, stream id)``; the copy is freed afterwards.
    The id is the one that Spark keeps in the stream's checkpoint.
    """
    if target is not None:
        checked = align_with_report(increment, target, on_extra)
    else:
        checked = increment.withColumn(REJECTED, F.lit(None).cast(REJECTED_TYPE))
    if shape is not None:
        checked = shape(checked)
    spark = increment.sparkSession
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or load_id
    staged, seen = f"increment-{uuid.uuid4().hex}", Observation()
    checked = checked.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.col(REJECTED)).alias("rejected")
    )
    try:
        checked = stage(checked, staged)
        n, rejected = seen.get["rows"], seen.get["rejected"]
        if rejected and reject_path is None:
            raise ValueError(
                f"increment {batch_id}: {rejected} rows do not fit the target "
                "and no reject_path is set"
            )
        if rejected:
            checked.where(F.col(REJECTED).isNotNull()).write.mode("overwrite").parquet(
                f"{reject_path}/stream={stream}/batch_id={batch_id}"
            )
        yield checked.where(F.col(REJECTED).isNull()).drop(REJECTED), n, rejected, stream
    finally:
        release(spark, staged)


def validated_append(
    path: str,
    target: T.StructType,
    *,
    reject_path: str | None = None,
    history_root: str | None = None,
    load_id: str = "stream",
    dedupe: bool = False,
    on_extra: str = "drop",
    fmt: str = "parquet",
    totals: dict[int, tuple[int, int]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """An ``on_batch`` for ``append_stream`` that checks each increment.

    Rows that fit ``target`` go to ``<path>/stream=<id>/batch_id=<n>``, others
    with a report of the misfit values to the same folder below ``reject_path``;
    without a reject path an increment with misfits fails. The id is the one
    that Spark keeps in the checkpoint: streams into one path keep apart, and a
    replay overwrites its own directory and history row. Empty increments write
    nothing. ``totals`` receives ``(rows, rejected)`` per increment.
    """

    def on_batch(increment: DataFrame, batch_id: int) -> None:
        spark = increment.sparkSession
        with _checked_increment(
            increment,
            batch_id,
            target,
            reject_path=reject_path,
            load_id=load_id,
            on_extra=on_extra,
            shape=drop_duplicate_rows if dedupe else None,
        ) as (good, n, rejected, stream):
            if totals is not None:
                totals[batch_id] = (n, rejected)
            if n - rejected:
                place = f"{path}/stream={stream}/batch_id={batch_id}"
                good.write.mode("overwrite").format(fmt).save(place)
            if history_root is not None:
                record_load(
                    spark,
                    history_root,
                    f"{stream}-{batch_id}",
                    "stream append",
                    path,
                    source_count=n,
                    transform_count=n - rejected,
                    reject_count=rejected,
                    rows_out=n - rejected,
                )

    return on_batch


def merged_increments(
    table: str,
    root: str,
    keys: str | list[str],
    recency: str | None = None,
    *,
    soft: bool = False,
    dedupe_batch: bool = False,
    target: T.StructType | None = None,
    reject_path: str | None = None,
    history_root: str | None = None,
    load_id: str = "stream",
    on_extra: str = "drop",
    partition_by: str | list[str] | None = None,
    totals: dict[int, tuple[int, int]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """An ``on_batch`` for ``append_stream`` that merges each increment into a table.

    Each increment is published as a version of its own, named by stream and
    increment. The table remembers the versions it had: an increment that comes
    again after it was published is left out, and one that failed before the
    table was moved to it is merged anew over its half-written folder. Rows
    that arrive late lose to newer ones by ``recency``, or with ``soft`` enter as
    inactive. ``target`` turns on validation, as in ``validated_append``; the
    first increment with rows makes the table where there is none. Streams into one
    table must not run at the same time.
    """

    def on_batch(increment: DataFrame, batch_id: int) -> None:
        spark = increment.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or load_id
        version = f"{stream}-{batch_id}"
        exists = spark.catalog.tableExists(table)
        if exists and has_batch(spark, table, version):
            return
        with _checked_increment(
            increment,
            batch_id,
            target,
            reject_path=reject_path,
            load_id=load_id,
            on_extra=on_extra,
        ) as (good, n, rejected, _):
            if totals is not None:
                totals[batch_id] = (n, rejected)
            if n == rejected:
                return
            if soft and ACTIVE_FLAG.lower() not in {c.lower() for c in good.columns}:
                good = good.withColumn(ACTIVE_FLAG, F.lit(1))
            latest = f"latest-{uuid.uuid4().hex}"
            try:
                if dedupe_batch:
                    # The merge reads its batch more than once.
                    good = stage(latest_per_key(good, keys, recency), latest)
                merged, parts = good, column_list(partition_by)
                if exists:
                    known = spark.table(table)
                    names = {c.lower() for c in known.columns}
                    if extra := [c for c in good.columns if c.lower() not in names]:
                        raise ValueError(f"columns {extra} are not in table {table}")
                    parts = partition_columns(spark, table)
                    merge = upsert_soft if soft else upsert
                    merged = merge(known, good.to(known.schema), keys, recency)
                written = publish(merged, table, root, version, parts)
            finally:
                release(spark, latest)
            if history_root is not None:
                record_load(
                    spark,
                    history_root,
                    version,
                    "stream merge",
                    table,
                    source_count=n,
                    transform_count=n - rejected,
                    reject_count=rejected,
                    rows_out=written,
                )

    return on_batch


def read_increments(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Everything ``validated_append`` has written to ``path``."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.format(fmt).load(path)
