"""All registered queries."""

from ..registry import REGISTRY
from . import core, dedup, dims, enrich, export, facts, feeds, matching, transforms  # noqa: F401

__all__ = ["REGISTRY"]
