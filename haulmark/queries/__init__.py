"""Named queries over the driver's tables, each with the SQL that must give the same rows.

The tables are read as file listings, upload and transfer logs, manifests and so on (see ``fixtures``).
"""

from haulmark.queries import (  # noqa: F401
    cleanup, compare, digests, layout, listings, scalars, stores, sync, transfers,
)
from haulmark.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
