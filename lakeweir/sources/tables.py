"""Warehouse tables: reading, inserting, publishing merges, lifecycle."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import column_list, quoted
from lakeweir.operators.align import align_schema
from lakeweir.operators.bounds import MAX_STRING_LENGTH, exceeds_bound
from lakeweir.operators.layout import even_layout, hash_layout
from lakeweir.sources.files import available_format, check_mode
from lakeweir.sources.staging import release, stage

STAGING_PREFIX = "STG_"  # fixed value: name of the view a post-load statement reads

# Table property that names a batch the table has; the batch's id follows.
BATCH_PROPERTY = "lakeweir.batch."

# Fixed value: the folder name of a null in a partition column.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Column of tables that are laid out by the batch each row came with.
BATCH_COLUMN = "ELT_BatchID"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns of a table or view."""
    return spark.table(name)


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """The result of a query over catalog tables and views."""
    return spark.sql(sql)


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table or a query of an external store.

    Without ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``options`` the store is read by a single task.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    reader = spark.read.format("jdbc").option("url", url)
    reader = reader.option("dbtable", table) if table else reader.option("query", query)
    return reader.options(**(options or {})).load()


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_columns_ddl(schema: T.StructType, max_len: int | None = None) -> str:
    """Column list for CREATE TABLE; strings bounded to ``max_len`` if given."""
    columns = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if max_len and isinstance(field.dataType, T.StringType):
            kind = f"varchar({max_len})"
        columns.append(f"`{field.name.replace('`', '``')}` {kind}")
    return ", ".join(columns)


def _partitioned_by(columns: list[str]) -> str:
    return f" PARTITIONED BY ({', '.join(f'`{c}`' for c in columns)})" if columns else ""


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    *,
    fmt: str = "parquet",
    partition_by: str | list[str] | None = None,
    options: Mapping[str, str] | None = None,
    max_len: int | None = None,
) -> None:
    """Make a written path known as an external table, unless it already is.

    The schema is stated, so no file has to be opened to find it and columns
    that only newer files have are not missed.
    """
    partition_by = column_list(partition_by)
    fmt = available_format(spark, fmt)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({table_columns_ddl(schema, max_len)}) USING {fmt}"
    if options:
        pairs = ", ".join(f"{_literal(k)} {_literal(v)}" for k, v in options.items())
        sql += f" OPTIONS ({pairs})"
    spark.sql(f"{sql}{_partitioned_by(partition_by)} LOCATION {_literal(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a schema; its managed tables live under ``location`` if given."""
    place = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def drop_schema(spark: SparkSession, name: str) -> None:
    """Drop a schema with its tables; data of external tables stays."""
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    """Save a frame as a managed table."""
    df.write.mode(check_mode(mode)).saveAsTable(name)


def _describe(spark: SparkSession, name: str) -> tuple[str, list[str]]:
    """Location and partition columns of a table, from one catalog lookup."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    names = [row["col_name"] for row in rows]
    location = next((r["data_type"] for r in rows if r["col_name"] == "Location"), "")
    parts: list[str] = []
    if "# Partition Information" in names:
        start = names.index("# Partition Information") + 2
        end = next(i for i in range(start, len(names)) if not names[i])
        parts = names[start:end]
    return location, parts


def table_location(spark: SparkSession, name: str) -> str:
    return _describe(spark, name)[0]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return _describe(spark, name)[1]


def is_current_version(spark: SparkSession, table: str, batch_id: str) -> bool:
    """Whether ``publish`` has already moved the table to this batch."""
    return table_location(spark, table).rstrip("/").endswith(f"/v={batch_id}")


def _holds(spark: SparkSession, table: str, path: str) -> bool:
    """Whether a path is inside the folder of a managed table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    told = {r["col_name"]: r["data_type"] for r in rows}
    plain = lambda p: p.removeprefix("file:").rstrip("/").replace("///", "/") + "/"
    return told.get("Type") == "MANAGED" and plain(path).startswith(plain(told["Location"]))


def batches_of(spark: SparkSession, table: str) -> set[str]:
    """The batches that were inserted into a table, merged into it, or replaced partitions of it."""
    kept = {
        row["key"].removeprefix(BATCH_PROPERTY)
        for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        if row["key"].startswith(BATCH_PROPERTY)
    }
    location = table_location(spark, table).rstrip("/")
    head, _, version = location.rpartition("/v=")
    return kept | {version} if head and "/" not in version else kept


def has_batch(spark: SparkSession, table: str, batch_id: str) -> bool:
    """Whether a table has a batch, the last one or any before it."""
    return batch_id in batches_of(spark, table)


def mark_batch(spark: SparkSession, table: str, *batch_ids: str) -> None:
    """Keep with the table which batches it has, so that a repeated load can tell."""
    pairs = ", ".join(f"{_literal(BATCH_PROPERTY + b)} = 'loaded'" for b in batch_ids)
    if pairs:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def staging_view_name(table: str) -> str:
    """The prefix goes to the last name part: views carry no schema."""
    return STAGING_PREFIX + table.rsplit(".", 1)[-1]


def _statements(sql: str | Iterable[str] | None) -> list[str]:
    if sql is None:
        return []
    return [s for s in ([sql] if isinstance(sql, str) else list(sql)) if s.strip()]


@contextmanager
def _partition_overwrite(spark: SparkSession, how: str):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, how)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    target = df.sparkSession.table(table)
    aligned, _ = align_schema(df, target.schema, on_extra="error", cast="store")
    parts = partition_columns(df.sparkSession, table)
    if parts:
        aligned = hash_layout(aligned, parts)
    with _partition_overwrite(df.sparkSession, "static"):
        aligned.write.insertInto(table, overwrite=overwrite)


def insert_table(
    df: DataFrame,
    table: str,
    mode: str,
    pre_sql: str | Iterable[str] | None = None,
    post_sql: str | Iterable[str] | None = None,
    cluster_by: str | list[str] | None = None,
    max_len: int = MAX_STRING_LENGTH,
    partition_by: str | list[str] | None = None,
    batch_id: str | None = None,
) -> bool:
    """Insert a batch into a table; returns whether the table now has it from this call.

    ``overwrite`` replaces the rows in one write and keeps the declared
    columns, bounded strings included. ``ignore`` leaves an existing table
    alone; ``error`` refuses one. A missing table is created, partitioned by
    ``partition_by`` and with strings bounded to ``max_len``. ``pre_sql`` runs before the load. With
    ``post_sql`` the batch is not inserted but staged, and the statements move
    it on from the view ``STG_<table>``. Each hook is one statement or a list.

    A table remembers every ``batch_id`` it got: one of them again, as when a
    load is repeated, runs no hook, inserts nothing and returns true. A failure
    between the insert and the note of it is not covered: ``insert_batch`` does
    that. A batch that reads the table it overwrites is refused by Spark; merge
    results go through ``publish``.
    """
    check_mode(mode)
    spark = df.sparkSession
    pre, post = _statements(pre_sql), _statements(post_sql)
    exists = spark.catalog.tableExists(table)
    if exists and batch_id is not None and has_batch(spark, table, batch_id):
        return True
    if exists and mode == "ignore":
        return False
    if exists and mode in ("error", "errorifexists"):
        raise ValueError(f"table {table} already exists")

    for statement in pre:
        spark.sql(statement)
    if cluster_by:
        df = hash_layout(df, cluster_by)
    if post:
        view = staging_view_name(table)
        staged = f"{view}-{uuid.uuid4().hex}"
        stage(df, staged).createOrReplaceTempView(view)
        try:
            for statement in post:
                spark.sql(statement)
        finally:
            spark.catalog.dropTempView(view)
            release(spark, staged)
        if batch_id is not None and spark.catalog.tableExists(table):
            mark_batch(spark, table, batch_id)
        return True
    if not spark.catalog.tableExists(table):
        sql = f"CREATE TABLE {table} ({table_columns_ddl(df.schema, max_len)}) USING parquet"
        spark.sql(sql + _partitioned_by(column_list(partition_by)))
    _insert(df, table, overwrite=mode == "overwrite")
    if batch_id is not None:
        mark_batch(spark, table, batch_id)
    return True


def _drop_batch(spark: SparkSession, table: str, batch_id: str) -> None:
    """Drop all partitions of a batch."""
    own = f"PARTITION ({BATCH_COLUMN} = {_literal(batch_id)})"
    specs = []
    for row in spark.sql(f"SHOW PARTITIONS {table} {own}").collect():
        parts = [part.split("=", 1) for part in row["partition"].split("/")]
        values = [
            f"`{unquote(name)}` = " + ("null" if value == NULL_PARTITION else _literal(unquote(value)))
            for name, value in parts
        ]
        specs.append(f"PARTITION ({', '.join(values)})")
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


def insert_batch(
    df: DataFrame,
    table: str,
    batch_id: str,
    partition_by: str | list[str] | None = None,
    max_len: int = MAX_STRING_LENGTH,
) -> int:
    """Insert a batch exactly once into a table that is laid out by batch; returns its rows.

    The table's first partition column is ``ELT_BatchID``. A batch owns the
    partitions under its id and overwrites them, so loading any batch again, the
    last one or one of long ago, after a success or a failure at any point,
    replaces what it left and nothing else. There is no note to be missed. A
    missing table is created, with ``partition_by`` below the batch.

    Without ``partition_by`` the one partition of a batch is replaced when the
    write is complete. With it, a repeated batch first gives up its partitions,
    as it may not have rows for all of them again: readers miss its rows until the
    write ends.
    """
    spark = df.sparkSession
    wanted = [BATCH_COLUMN, *column_list(partition_by)]
    own = f"PARTITION ({BATCH_COLUMN} = {_literal(batch_id)})"
    if BATCH_COLUMN.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the batch has a column {BATCH_COLUMN} of its own")
    if not spark.catalog.tableExists(table):
        columns = f"{table_columns_ddl(df.schema, max_len)}, {BATCH_COLUMN} string"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{_partitioned_by(wanted)}")
    parts = partition_columns(spark, table)
    if not parts or parts[0].lower() != BATCH_COLUMN.lower():
        raise ValueError(f"table {table} is not partitioned by {BATCH_COLUMN} first")
    repeated = not spark.sql(f"SHOW PARTITIONS {table} {own}").isEmpty()
    target = spark.table(table)
    given = T.StructType([f for f in target.schema.fields if f.name.lower() != BATCH_COLUMN.lower()])
    aligned, _ = align_schema(df, given, on_extra="error", cast="store")
    if repeated and len(parts) > 1:
        _drop_batch(spark, table, batch_id)
    if len(parts) > 1:
        aligned = hash_layout(aligned, parts[1:])
    counted = Observation()
    aligned = aligned.observe(counted, F.count(F.lit(1)).alias("rows"))
    aligned = aligned.withColumn(BATCH_COLUMN, F.lit(batch_id)).select(*[quoted(c) for c in target.columns])
    with _partition_overwrite(spark, "dynamic"):
        aligned.write.insertInto(table, overwrite=True)
    if repeated and not counted.get["rows"]:
        # Nothing was written, so nothing was overwritten either.
        _drop_batch(spark, table, batch_id)
    spark.catalog.refreshTable(table)
    return counted.get["rows"]


def write_temp_table(
    df: DataFrame,
    name: str,
    hash_column: str | list[str] | None = None,
    partitions: int | None = None,
    buckets: int | None = None,
) -> None:
    """Overwrite a working table, spread by a hash column or evenly.

    ``buckets`` also records the hash layout in the catalog, so joins and
    aggregates on the column need no exchange. A bucket is read by one task:
    leave it out where one value holds a large share of the rows.
    """
    hashed = column_list(hash_column)
    if buckets and not hashed:
        raise ValueError("buckets need a hash column")
    laid_out = hash_layout(df, hashed, partitions) if hashed else even_layout(df, partitions)
    writer = laid_out.write.mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, *hashed)
    writer.saveAsTable(name)


def publish(
    df: DataFrame,
    table: str,
    root: str,
    batch_id: str,
    partition_by: str | list[str] | None = None,
    max_len: int | None = MAX_STRING_LENGTH,
) -> int:
    """Write a new version of a table and point the table at it.

    Plain file tables have no row-level delete, and overwriting a path that
    the plan reads would destroy it. So the result goes to
    ``<root>/v=<batch_id>`` and the catalog entry is moved once the write is
    complete: readers see the old version or the new one. A version holding a
    string of more than ``max_len`` characters is refused and stays unused.
    Returns the number of rows written; it is counted in the last stage of the
    write, where a retried task is counted once.
    """
    spark = df.sparkSession
    partition_by = column_list(partition_by)
    path = f"{root.rstrip('/')}/v={batch_id}"
    exists = spark.catalog.tableExists(table)
    if exists and is_current_version(spark, table, batch_id):
        raise ValueError(f"batch {batch_id} is the current version of {table}")
    if exists and _holds(spark, table, path):
        # Dropping a managed table deletes its folder, and a new version in it.
        raise ValueError(f"{path} is inside the folder of the managed table {table}")

    counted = Observation()
    laid_out = hash_layout(df, partition_by) if partition_by else df
    checked = laid_out.observe(
        counted,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(exceeds_bound(df, max_len)).alias("overlong"),
    )
    writer = checked.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if counted.get["overlong"]:
        raise ValueError(
            f"{counted.get['overlong']} rows for {table} hold strings of more than {max_len} "
            "characters"
        )

    # Batches that the table had before it had this one.
    before = batches_of(spark, table) if exists else set()
    if exists and not partition_by:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(path)}")
    else:
        # The catalog keeps a location per partition, which moving the table
        # would not change. The new version is outside of what a drop deletes.
        if exists:
            drop_table(spark, table)
        register_table(
            spark, table, path, df.schema, partition_by=partition_by, max_len=max_len
        )
    mark_batch(spark, table, *sorted(before))
    spark.catalog.refreshTable(table)
    return counted.get["rows"]


def retire_version(spark: SparkSession, table: str, root: str, batch_id: str) -> None:
    """Free the storage of a version that ``publish`` has since replaced.

    The version is overwritten by an empty one. Call it when no reader that
    started before the replacement is still at work.
    """
    path = f"{root.rstrip('/')}/v={batch_id}"
    if is_current_version(spark, table, batch_id):
        raise ValueError(f"{batch_id} is the current version of {table}")
    empty = spark.createDataFrame([], spark.table(table).schema)
    empty.drop(*partition_columns(spark, table)).write.mode("overwrite").parquet(path)


def touched_partitions(target: DataFrame, batch: DataFrame, columns: str | list[str]) -> DataFrame:
    """Target rows in partitions that the batch also has rows in.

    The range of the batch's values in each column becomes a filter that prunes
    the scan, whatever their number; a semi-join on the executors then leaves
    only the partitions themselves.
    """
    columns = column_list(columns)
    values = batch.select(*[quoted(c) for c in columns]).distinct()
    bounds = values.agg(
        *[F.min(quoted(c)).alias(f"low{i}") for i, c in enumerate(columns)],
        *[F.max(quoted(c)).alias(f"high{i}") for i, c in enumerate(columns)],
        *[
            F.coalesce(F.bool_or(quoted(c).isNull()), F.lit(False)).alias(f"null{i}")
            for i, c in enumerate(columns)
        ],
    ).first()
    for i, c in enumerate(columns):
        inside = F.lit(False)
        if bounds[f"low{i}"] is not None:
            inside = quoted(c).between(F.lit(bounds[f"low{i}"]), F.lit(bounds[f"high{i}"]))
        target = target.where(inside | quoted(c).isNull() if bounds[f"null{i}"] else inside)
    same = reduce(
        lambda a, b: a & b,
        [quoted(c, "rows").eqNullSafe(quoted(c, "parts")) for c in columns],
    )
    return target.alias("rows").join(values.alias("parts"), same, "left_semi")


def replace_partitions(df: DataFrame, table: str) -> int:
    """Overwrite just the partitions ``df`` has rows in; returns its row count.

    ``df`` may read the same table: Spark moves the new files in only after
    the last task has finished. Right for merges whose keys never change
    partition, since a partition left without rows would not be touched.
    """
    spark = df.sparkSession
    columns = partition_columns(spark, table)
    if not columns:
        raise ValueError(f"table {table} is not partitioned")
    counted = Observation()
    laid_out = hash_layout(df, columns).observe(counted, F.count(F.lit(1)).alias("rows"))
    ordered = laid_out.select(*[quoted(c) for c in spark.table(table).columns])
    with _partition_overwrite(spark, "dynamic"):
        ordered.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    return counted.get["rows"]
