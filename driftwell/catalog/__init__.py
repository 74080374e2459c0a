"""Named runs of the operators on the test tables, each with its SQL equivalent."""

from driftwell.catalog import (  # noqa: F401  (importing registers the entries)
    cleaning,
    drift,
    learning,
    ordered,
    profiles,
    quality,
    runs,
    splits,
    windows,
)
from driftwell.catalog.registry import entries

__all__ = ["entries"]
