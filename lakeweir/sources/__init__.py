"""Datasets, tables and intermediate storage."""

from lakeweir.sources.csv_split import multiline_records, read_multiline_csv
from lakeweir.sources.files import read_dataset, read_path, write_dataset, write_path
from lakeweir.sources.history import load_history, record_load
from lakeweir.sources.staging import materialize, shared_dir, stage
from lakeweir.sources.tables import (
    create_schema,
    drop_schema,
    drop_table,
    insert_batch,
    insert_table,
    publish,
    read_jdbc,
    read_query,
    read_table,
    register_table,
    replace_partitions,
    retire_version,
    save_table,
    touched_partitions,
    write_temp_table,
)
from lakeweir.sources.zones import choose_format, dataset_path

__all__ = [
    "choose_format",
    "create_schema",
    "dataset_path",
    "drop_schema",
    "drop_table",
    "insert_batch",
    "insert_table",
    "load_history",
    "materialize",
    "multiline_records",
    "publish",
    "read_dataset",
    "read_jdbc",
    "read_multiline_csv",
    "read_path",
    "read_query",
    "read_table",
    "record_load",
    "register_table",
    "replace_partitions",
    "retire_version",
    "save_table",
    "shared_dir",
    "stage",
    "touched_partitions",
    "write_dataset",
    "write_path",
    "write_temp_table",
]
