"""Complete loads composed from the operators."""

from lakeweir.plans.batch import BatchSpec, LoadResult, ingest_batch
from lakeweir.plans.stream import StreamSpec, ingest_stream, table_count

__all__ = [
    "BatchSpec",
    "LoadResult",
    "StreamSpec",
    "ingest_batch",
    "ingest_stream",
    "table_count",
]
