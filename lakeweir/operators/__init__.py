"""DataFrame-to-DataFrame operators."""

from lakeweir.operators.align import align_schema, align_with_report, casts_can_fail
from lakeweir.operators.bounds import MAX_STRING_LENGTH, overlong_rows, string_bound_report
from lakeweir.operators.dedupe import drop_duplicate_rows, latest_per_key
from lakeweir.operators.flatten import flatten, parse_json_column
from lakeweir.operators.layout import even_layout, hash_layout, preview, range_layout
from lakeweir.operators.merge import (
    ACTIVE_FLAG,
    append_rows,
    flag_outdated,
    flag_superseded,
    remove_outdated,
    remove_superseded,
    replace_keys,
    upsert,
    upsert_soft,
)
from lakeweir.operators.names import strip_column_spaces
from lakeweir.operators.sieve import SIEVE_BITS, may_match, split_by_keys

__all__ = [
    "ACTIVE_FLAG",
    "MAX_STRING_LENGTH",
    "SIEVE_BITS",
    "align_schema",
    "align_with_report",
    "append_rows",
    "casts_can_fail",
    "drop_duplicate_rows",
    "even_layout",
    "flag_outdated",
    "flag_superseded",
    "flatten",
    "hash_layout",
    "latest_per_key",
    "may_match",
    "overlong_rows",
    "parse_json_column",
    "preview",
    "range_layout",
    "remove_outdated",
    "remove_superseded",
    "replace_keys",
    "split_by_keys",
    "string_bound_report",
    "strip_column_spaces",
    "upsert",
    "upsert_soft",
]
