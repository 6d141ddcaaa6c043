"""All registered queries, imported for their side effect of registering."""

from tallyfold.plans import catalog_shares, catalog_stored, catalog_tables, catalog_text  # noqa: F401
from tallyfold.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
