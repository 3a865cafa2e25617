"""The library's operators bound to the driver's tables, each with its SQL oracle."""

from hearthline.bindings.registry import oracles, registered

# Importing a module registers its queries.
from hearthline.bindings import (  # noqa: F401  isort: skip
    analytics,
    cleaning,
    dashboards,
    ingest,
    pipeline_metrics,
    quality,
    streams,
)

__all__ = ["oracles", "registered"]
