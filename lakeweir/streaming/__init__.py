"""Incremental loads with Structured Streaming."""

from lakeweir.streaming.schemas import evolve_schema, load_schema, merge_schemas, save_schema
from lakeweir.streaming.streams import (
    append_stream,
    file_stream,
    read_increments,
    merged_increments,
    validated_append,
)
from lakeweir.streaming.variants import infer_json_schema, open_json

__all__ = [
    "append_stream",
    "evolve_schema",
    "file_stream",
    "infer_json_schema",
    "load_schema",
    "merge_schemas",
    "open_json",
    "read_increments",
    "save_schema",
    "merged_increments",
    "validated_append",
]
