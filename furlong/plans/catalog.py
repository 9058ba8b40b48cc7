"""All queries of the library."""

from . import catalog_audit, catalog_features, catalog_fits, catalog_forms, catalog_groups, catalog_history, catalog_models, catalog_rows, catalog_rules, catalog_runs  # noqa: F401  they register their queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
