"""The subpackage's queries and SQL, added by the entry module if this can be imported."""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
