"""Column-level helpers: argument parsing, audit columns, comparable keys."""

from lakeweir.functions.audit import AUDIT_COLUMNS, add_audit
from lakeweir.functions.columns import column_list, comparable, quoted, truthy

__all__ = ["AUDIT_COLUMNS", "add_audit", "column_list", "comparable", "quoted", "truthy"]
