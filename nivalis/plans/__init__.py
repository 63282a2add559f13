"""Composite plans and the registered queries (importing this fills the registry)."""

from . import registry  # noqa: F401
from . import q_grid, q_records, q_transforms, q_io  # noqa: F401

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
