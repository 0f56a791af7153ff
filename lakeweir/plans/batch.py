"""Batch load: read, shape, audit, merge or insert, write to the lake, report."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.audit import AUDIT_COLUMNS, TENANT_COLUMN, add_audit
from lakeweir.functions.columns import blank_to_none, column_list, fresh_name, quoted, truthy
from lakeweir.operators.align import (
    REJECTED,
    REJECTED_TYPE,
    align_with_report,
    casts_can_fail,
)
from lakeweir.operators.dedupe import drop_duplicate_rows, latest_per_key
from lakeweir.operators.flatten import flatten
from lakeweir.operators.merge import ACTIVE_FLAG, upsert, upsert_soft
from lakeweir.operators.names import strip_column_spaces
from lakeweir.sources.files import DEFAULT_FORMAT, read_dataset, read_path, write_dataset
from lakeweir.sources.history import record_load, target_folder
from lakeweir.sources.staging import release, stage
from lakeweir.sources.tables import (
    BATCH_COLUMN,
    has_batch,
    insert_batch,
    insert_table,
    mark_batch,
    partition_columns,
    publish,
    replace_partitions,
    touched_partitions,
)
from lakeweir.sources.zones import RAW, choose_format, dataset_path

MERGES = ("newest", "soft")
ON_REJECT = ("null", "quarantine", "error")

# Formats whose writers the column-name clean-up is for.
SPACELESS = ("parquet", "delta")

# Formats that return every value as it was written.
REREADABLE = ("parquet", "orc")


@dataclass
class BatchSpec:
    """Parameters of one batch load; blank strings count as not set."""

    zones: Mapping[str, str]
    container: str
    folder: str | None = None
    file: str | None = None
    fmt: str | None = None
    sep: str | None = None
    header: object = True
    multiline: bool | None = None
    schema: T.StructType | str | None = None
    dedupe: bool = True
    recursive: bool = False

    flatten: bool = False
    explode_columns: str | list[str] | None = None
    tenant: str | None = None
    instance_id: object = None
    load_time: dt.datetime | None = None

    target_schema: T.StructType | None = None
    on_extra: str = "error"
    on_reject: str = "error"
    truncate: bool = False
    reject_path: str | None = None

    table: str | None = None
    table_root: str | None = None
    table_mode: str = "append"
    by_batch: bool = False
    merge: str | None = None
    keys: str | list[str] | None = None
    recency: str | None = None
    dedupe_batch: bool = False
    keys_fix_partition: bool = False
    sift: bool = False

    curated_zone: str = "curated1"
    curated_container: str | None = None
    curated_folder: str | None = None
    curated_file: str | None = None
    curated_format: str = "parquet"
    curated_mode: str = "overwrite"
    curated_sep: str | None = None
    partition_by: str | list[str] | None = None

    history_root: str | None = None
    batch_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def check(self) -> None:
        """Reject combinations that would quietly do nothing or lose rows."""
        if self.merge is not None:
            if self.merge not in MERGES:
                raise ValueError(f"merge must be one of {MERGES}, not {self.merge!r}")
            if not column_list(self.keys):
                raise ValueError("a merge load needs key columns")
            if not self.table or not self.table_root:
                raise ValueError("a merge load needs a table and a table_root")
            if self.dedupe_batch and not blank_to_none(self.recency):
                raise ValueError("dedupe_batch needs a recency column")
        elif column_list(self.keys):
            raise ValueError("key columns are set but no merge is chosen")
        if self.by_batch and (self.merge is not None or self.table_mode != "append" or not self.table):
            raise ValueError("a table by batch is one that batches are appended to")
        if self.on_reject not in ON_REJECT:
            raise ValueError(f"on_reject must be one of {ON_REJECT}, not {self.on_reject!r}")
        if self.on_reject == "quarantine" and not self.reject_path:
            raise ValueError("quarantine needs a reject_path")


@dataclass
class LoadResult:
    """What one load did. ``raw_count`` counts rows before de-duplication."""

    batch_id: str
    operation: str
    raw_count: int
    source_count: int
    transform_count: int
    reject_count: int = 0
    rows_out: int | None = None

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(asdict(self).values())],
            "batch_id string, operation string, raw_count long, source_count long, "
            "transform_count long, reject_count long, rows_out long",
        )


def _alignment_target(
    spark: SparkSession, spec: BatchSpec, columns: list[str]
) -> T.StructType | None:
    """Columns the source has to supply: the table's, without those this load adds.

    A tenant column that no ``tenant`` fills, and an active flag that the source
    has, are the source's own.
    """
    if spec.target_schema is not None:
        return spec.target_schema
    if not spec.table or not spark.catalog.tableExists(spec.table):
        return None
    added = {name.lower() for name in AUDIT_COLUMNS}
    if spec.by_batch:
        added.add(BATCH_COLUMN.lower())
    if spec.tenant is None:
        added.discard(TENANT_COLUMN.lower())
    if spec.merge == "soft" and ACTIVE_FLAG.lower() not in {c.lower() for c in columns}:
        added.add(ACTIVE_FLAG.lower())
    return T.StructType(
        [f for f in spark.table(spec.table).schema.fields if f.name.lower() not in added]
    )


def _has_batch(spark: SparkSession, spec: BatchSpec) -> bool:
    return (
        blank_to_none(spec.table) is not None
        and not spec.by_batch
        and spark.catalog.tableExists(spec.table)
        and has_batch(spark, spec.table, spec.batch_id)
    )


def _insert(spec: BatchSpec, batch: DataFrame) -> bool:
    """Insert the batch unless the table has it; false where the mode leaves the table alone."""
    if spec.by_batch:
        insert_batch(batch, spec.table, spec.batch_id, spec.partition_by)
        return True
    return insert_table(
        batch,
        spec.table,
        spec.table_mode,
        partition_by=spec.partition_by,
        batch_id=spec.batch_id,
    )


def _curated_format(spec: BatchSpec) -> str:
    return choose_format("", spec.curated_format or DEFAULT_FORMAT)


def _raw(spark: SparkSession, spec: BatchSpec) -> DataFrame:
    return read_dataset(
        spark,
        spec.zones,
        RAW,
        spec.container,
        spec.folder,
        spec.file,
        fmt=spec.fmt,
        sep=spec.sep,
        header=spec.header is True or truthy(spec.header),
        multiline=spec.multiline,
        schema=spec.schema,
        dedupe=False,
        recursive=spec.recursive,
    )


def _shaped(
    spark: SparkSession, spec: BatchSpec, raw: DataFrame
) -> tuple[DataFrame, str, bool, Observation, Observation]:
    """The batch as it will be stored, with row counts attached to its plan.

    Returns it with a report column, the column's name, and whether it can hold
    anything.

    Counts are taken after the last shuffle. Spark adds up a count of an
    earlier stage again when a lost executor makes that stage run twice; the
    number of raw rows is therefore carried along by the de-duplication as a
    count of copies instead of being counted at the scan.
    """
    copies = fresh_name(raw, "__copies")
    if spec.dedupe:
        df = drop_duplicate_rows(raw, copies=copies)
    else:
        df = raw.withColumn(copies, F.lit(1).cast("long"))
    read_counts, written_counts = Observation(), Observation()
    df = df.observe(
        read_counts,
        F.count(F.lit(1)).alias("source"),
        F.coalesce(F.sum(quoted(copies)), F.lit(0)).alias("raw"),
    ).drop(copies)

    if spec.flatten:
        df = flatten(df, explode_columns=spec.explode_columns)
    if _curated_format(spec) in SPACELESS:
        df = strip_column_spaces(df)
    target = _alignment_target(spark, spec, df.columns)
    may_reject = target is not None and casts_can_fail(df, target)
    # The source may have a column of this name, as our own quarantine files do.
    report = fresh_name(df, REJECTED)
    if target is not None:
        df = align_with_report(df, target, spec.on_extra, report, spec.truncate)
    else:
        df = df.withColumn(report, F.lit(None).cast(REJECTED_TYPE))
    df = df.observe(
        written_counts,
        F.count(F.lit(1)).alias("rows"),
        F.count(quoted(report)).alias("rejected"),
    )
    source = dataset_path(spec.zones, RAW, spec.container, spec.folder, spec.file)
    audited = add_audit(df, spec.instance_id, source, spec.load_time, spec.tenant)
    return audited, report, may_reject, read_counts, written_counts


def _merge(spark: SparkSession, spec: BatchSpec, batch: DataFrame, run: str) -> int:
    """Merge into the table and publish; returns the rows written."""
    exists = spark.catalog.tableExists(spec.table)
    if exists and has_batch(spark, spec.table, spec.batch_id):
        # A repeated run of a load that has merged, or failed after its merge.
        return spark.table(spec.table).count()
    if spec.merge == "soft" and ACTIVE_FLAG.lower() not in {c.lower() for c in batch.columns}:
        batch = batch.withColumn(ACTIVE_FLAG, F.lit(1))
    if exists:
        known = spark.table(spec.table).schema
        names = {c.lower() for c in known.names}
        if extra := [c for c in batch.columns if c.lower() not in names]:
            raise ValueError(f"columns {extra} are not in table {spec.table}")
        batch = batch.to(known)
    if spec.dedupe_batch:
        # The merge reads its batch more than once.
        batch = stage(latest_per_key(batch, spec.keys, spec.recency), f"latest-{run}")
    if not exists:
        return publish(
            batch, spec.table, spec.table_root, spec.batch_id, column_list(spec.partition_by)
        )

    target = spark.table(spec.table)
    parts = partition_columns(spark, spec.table)
    in_place = bool(parts) and spec.keys_fix_partition
    if in_place:
        target = touched_partitions(target, batch, parts)
    if spec.merge == "soft":
        merged = upsert_soft(target, batch, spec.keys, blank_to_none(spec.recency), sift=spec.sift)
    else:
        merged = upsert(target, batch, spec.keys, blank_to_none(spec.recency), sift=spec.sift)
    if in_place:
        rows = replace_partitions(merged, spec.table)
        mark_batch(spark, spec.table, spec.batch_id)
        return rows
    return publish(merged, spec.table, spec.table_root, spec.batch_id, parts)


def _write_curated(spec: BatchSpec, batch: DataFrame) -> str:
    return write_dataset(
        batch,
        spec.zones,
        spec.curated_zone,
        spec.curated_container or spec.container,
        spec.curated_folder,
        spec.curated_file,
        fmt=spec.curated_format,
        mode=spec.curated_mode,
        sep=spec.curated_sep,
        partition_by=spec.partition_by or (),
    )


def _target(spec: BatchSpec) -> str:
    """What a load writes: its table, else its place in the lake."""
    if blank_to_none(spec.table):
        return spec.table
    place = (spec.curated_zone, spec.curated_container or spec.container, spec.curated_folder, spec.curated_file)
    return "/".join(part for part in place if part)


def _record(spark: SparkSession, spec: BatchSpec, result: LoadResult) -> LoadResult:
    if spec.history_root:
        record_load(
            spark,
            spec.history_root,
            spec.batch_id,
            result.operation,
            _target(spec),
            raw_count=result.raw_count,
            source_count=result.source_count,
            transform_count=result.transform_count,
            reject_count=result.reject_count,
            rows_out=result.rows_out,
        )
    return result


def ingest_batch(spark: SparkSession, spec: BatchSpec) -> LoadResult:
    """Run one batch load, and free what it staged.

    The source is evaluated once. Where the lake copy can be read back as it
    was (``REREADABLE``, overwritten, unpartitioned), it is written first and
    the merge or insert reads it; an insert without a lake copy goes straight
    to the table; otherwise the batch is staged in Parquet. Row counts come
    with that first write.

    An empty batch touches neither the table nor the lake. Values that do not
    fit the target stop the load before anything is changed
    (``on_reject="error"``, the default), are moved with their row to
    ``reject_path`` (``"quarantine"``), or are null in the stored row and counted
    (``"null"``). Columns that the target lacks stop it too, unless
    ``on_extra="drop"`` gives them up.

    A load that is started again under its batch id neither inserts nor merges
    again, however many others came between. With ``by_batch`` the table is laid
    out by batch, and a repeated load replaces its own rows, so that a failure at any
    point of the first attempt leaves no copy behind.
    """
    spec.check()
    # Loads of other tables, or of this one, may run under the same batch id at the same time.
    run = f"{spec.batch_id}-{uuid.uuid4().hex}"
    try:
        return _ingest(spark, spec, run)
    finally:
        for name in (f"batch-{run}", f"latest-{run}"):
            release(spark, name)


def _ingest(spark: SparkSession, spec: BatchSpec, run: str) -> LoadResult:
    raw = _raw(spark, spec)
    result = LoadResult(spec.batch_id, "none", 0, 0, 0)
    if raw.isEmpty():
        return _record(spark, spec, result)

    shaped, report, may_reject, read_counts, written_counts = _shaped(spark, spec, raw)
    merges = spec.merge is not None
    inserts = not merges and blank_to_none(spec.table) is not None
    curates = bool(blank_to_none(spec.curated_folder) or blank_to_none(spec.curated_file))
    unfiltered = spec.on_reject == "null" or not may_reject
    # Gathering partitions is a shuffle, after which counts would be unsafe.
    lake_first = (
        unfiltered
        and curates
        and _curated_format(spec) in REREADABLE
        and spec.curated_mode == "overwrite"
        and not column_list(spec.partition_by)
    )
    # A table that has this batch already is not inserted into again; counts then
    # have to come with another write.
    table_first = (
        unfiltered
        and not _has_batch(spark, spec)
        and inserts
        and not curates
        and spec.table_mode in ("append", "overwrite")
        and not column_list(spec.partition_by)
        and not (
            spark.catalog.tableExists(spec.table) and partition_columns(spark, spec.table)
        )
    )
    if lake_first:
        batch = shaped.drop(report)
        path = _write_curated(spec, batch)
        batch = read_path(spark, path, _curated_format(spec), schema=batch.schema)
    elif table_first:
        _insert(spec, shaped.drop(report))
        batch = None
    else:
        batch = stage(shaped, f"batch-{run}")

    counts, written = read_counts.get, written_counts.get
    result.raw_count, result.source_count = counts["raw"], counts["source"]
    result.transform_count, result.reject_count = written["rows"], written["rejected"]
    if not unfiltered and result.reject_count:
        if spec.on_reject == "error":
            raise ValueError(
                f"{result.reject_count} rows hold values that do not fit the target"
            )
        batch.where(quoted(report).isNotNull()).write.mode("overwrite").parquet(
            f"{spec.reject_path.rstrip('/')}/batch_id={spec.batch_id}/{target_folder(_target(spec))}"
        )
        batch = batch.where(quoted(report).isNull())
        result.transform_count -= result.reject_count
        if not result.transform_count:
            return _record(spark, spec, result)
    if batch is not None and not lake_first:
        batch = batch.drop(report)

    if merges:
        result.operation = f"upsert {spec.merge}"
        result.rows_out = _merge(spark, spec, batch, run)
    elif inserts:
        result.operation = f"insert {spec.table_mode}"
        result.rows_out = result.transform_count
        if not table_first and not _insert(spec, batch):
            result.rows_out = 0
    elif curates:
        result.operation = f"write {spec.curated_mode}"
    if curates and not lake_first:
        _write_curated(spec, batch)
    return _record(spark, spec, result)
