"""The registered queries and, where SQL can express them, the same rows in DuckDB SQL."""

from .plans.catalogue import QUERIES
from .plans.catalogue_sql import SQL

__all__ = ["QUERIES", "SQL"]
