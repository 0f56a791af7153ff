"""Reading and writing file datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.columns import blank_to_none, column_list
from lakeweir.operators.dedupe import drop_duplicate_rows
from lakeweir.operators.layout import hash_layout
from lakeweir.sources.csv_split import LISTING_OPTIONS, can_split, read_multiline_csv
from lakeweir.sources.zones import PLAIN, RAW, choose_format, dataset_path

# What the CSV sink writes for a null and how it writes a timestamp.
CSV_NULL = "0"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

DEFAULT_FORMAT = "parquet"

# Spark's save modes.
SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def check_mode(mode: str | None) -> str:
    """The save mode, or an error that names the choices."""
    if mode not in SAVE_MODES:
        raise ValueError(f"write mode must be one of {SAVE_MODES}, not {mode!r}")
    return mode


def available_format(spark: SparkSession, fmt: str) -> str:
    """The format, unless it is ``delta`` and the session is not set up for that."""
    if fmt != "delta":
        return fmt
    if "delta" in spark.conf.get("spark.sql.extensions", "").lower():
        return fmt
    raise ValueError("this session has no Delta support; name another format")


def _has_large_file(
    spark: SparkSession, path: str, recursive: bool, options: Mapping[str, str] | None
) -> bool:
    """Whether a file is larger than ``spark.sql.files.maxPartitionBytes``; lists files and opens none."""
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    listing = {k: v for k, v in (options or {}).items() if k.lower() in LISTING_OPTIONS}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return not files.options(**listing).load(path).where(F.col("length") > limit).select("length").isEmpty()


def read_path(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    *,
    sep: str | None = None,
    header: bool = True,
    multiline: bool = False,
    schema: T.StructType | str | None = None,
    recursive: bool = False,
    split: bool | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a path.

    CSV and JSON infer their types in an extra pass over the text unless
    ``schema`` is given. Multi-line JSON files cannot be split: one file is one
    task. Multi-line CSV files are split where ``split`` says so, or by default
    where one of them is larger than a scan task is meant to read.
    """
    fmt = available_format(spark, choose_format(path, fmt))
    sep = blank_to_none(sep)
    if split and not (fmt == "csv" and multiline):
        raise ValueError("split is for multi-line CSV")
    if fmt == "csv" and multiline and split is None:
        split = can_split(options) and _has_large_file(spark, path, recursive, options)
    if split:
        return read_multiline_csv(
            spark,
            path,
            sep=sep,
            header=header,
            schema=schema,
            recursive=recursive,
            options=options,
        )
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", header).option("multiLine", multiline)
        if header and schema is None:
            # Spark reads CSV columns by position: refuse a file whose header names
            # others than the file that names were taken from.
            reader = reader.option("enforceSchema", False)
        if schema is None:
            reader = reader.option("inferSchema", True)
        if sep is not None:
            reader = reader.option("sep", sep)
    elif fmt == "json":
        reader = reader.option("multiLine", multiline)
    reader = reader.options(**(options or {}))
    return reader.format("csv" if fmt == PLAIN else fmt).load(path)


def read_dataset(
    spark: SparkSession,
    zones: Mapping[str, str],
    zone: str,
    container: str,
    folder: str | None = None,
    file: str | None = None,
    *,
    fmt: str | None = None,
    sep: str | None = None,
    header: bool = True,
    multiline: bool | None = None,
    schema: T.StructType | str | None = None,
    dedupe: bool = True,
    dedupe_keys: str | list[str] | None = None,
    recursive: bool = False,
    split: bool | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read one dataset of a zone and drop duplicate rows.

    Records that span lines are the default for raw CSV and for JSON outside
    the raw zone; raw JSON has one document per line. ``dedupe=False`` keeps
    copies and lets Spark prune columns down to the scan, which whole-row
    comparison rules out; ``dedupe_keys`` compares some columns only.
    """
    path = dataset_path(zones, zone, container, folder, file)
    if multiline is None:
        multiline = (zone == RAW) == (choose_format(path, fmt) == "csv")
    df = read_path(
        spark,
        path,
        fmt,
        sep=sep,
        header=header,
        multiline=multiline,
        schema=schema,
        recursive=recursive,
        split=split,
        options=options,
    )
    return drop_duplicate_rows(df, dedupe_keys) if dedupe else df


def write_path(
    df: DataFrame,
    path: str,
    *,
    fmt: str | None = DEFAULT_FORMAT,
    mode: str = "overwrite",
    sep: str | None = None,
    header: bool = True,
    null_value: str = CSV_NULL,
    partition_by: str | Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a frame to a path.

    A partitioned write first gathers each partition's rows, so tasks do not
    each leave a small file in every partition; partitions that outgrow a task
    are split. CSV cannot tell a null from ``null_value``.
    """
    check_mode(mode)
    fmt = available_format(df.sparkSession, choose_format(path, fmt or DEFAULT_FORMAT))
    partition_by = column_list(partition_by)
    if partition_by:
        df = hash_layout(df, partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(
            header=header,
            nullValue=null_value,
            timestampFormat=CSV_TIMESTAMP,
            timestampNTZFormat=CSV_TIMESTAMP,
        )
        sep = blank_to_none(sep)
        if sep is not None:
            writer = writer.option("sep", sep)
    writer.options(**(options or {})).format(fmt).save(path)


def write_dataset(
    df: DataFrame,
    zones: Mapping[str, str],
    zone: str,
    container: str,
    folder: str | None = None,
    file: str | None = None,
    **how,
) -> str:
    """Write one dataset of a zone (options of ``write_path``); returns its path."""
    path = dataset_path(zones, zone, container, folder, file)
    write_path(df, path, **how)
    return path
