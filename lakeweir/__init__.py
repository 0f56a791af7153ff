"""Loading files and streams into lake tables, and merging them by key."""

from lakeweir.functions import AUDIT_COLUMNS, add_audit, column_list
from lakeweir.operators import *  # noqa: F403
from lakeweir.operators import __all__ as _operators
from lakeweir.plans import *  # noqa: F403
from lakeweir.plans import __all__ as _plans
from lakeweir.sources import *  # noqa: F403
from lakeweir.sources import __all__ as _sources
from lakeweir.streaming import *  # noqa: F403
from lakeweir.streaming import __all__ as _streaming

__all__ = [
    "AUDIT_COLUMNS",
    "add_audit",
    "column_list",
    *_operators,
    *_plans,
    *_sources,
    *_streaming,
]
