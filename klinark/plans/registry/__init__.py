"""All runnable queries over the given tables, with their equivalent SQL."""

from klinark.plans.registry import cleaning, lifecycle, quality, sources, steering, warehouse  # noqa: F401
from klinark.plans.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
