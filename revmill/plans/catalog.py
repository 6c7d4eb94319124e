"""All registered queries."""

from revmill.plans import (  # noqa: F401
    catalog_counts,
    catalog_jobs,
    catalog_metrics,
    catalog_rows,
    catalog_stream,
    catalog_text,
)
from revmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
