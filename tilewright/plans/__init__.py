"""Registered queries: importing this package fills the registry."""

from tilewright.plans import builds, catalogue, contracts, listings, rasters, spatial  # noqa: F401
from tilewright.plans.registry import QUERIES, SQL  # noqa: F401
