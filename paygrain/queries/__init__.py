"""The library's operators run on the given tables, each with an SQL statement of the same result."""

from . import aggregates, dims, incremental, ingest, joins, measures, quality, rules, writes  # noqa: F401
from .base import REGISTRY, oracle_sql, run  # noqa: F401
