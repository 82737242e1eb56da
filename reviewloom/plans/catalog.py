"""All registered queries. Importing the parts registers them."""

from reviewloom.plans import catalog_models, catalog_relational, catalog_series, catalog_text  # noqa: F401
from reviewloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
