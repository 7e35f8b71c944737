"""The registered queries on the driver tables, each with the SQL that states its result."""

from workload import geo, lookups, maintenance, nested, ranking, streams  # noqa: F401
from workload.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
