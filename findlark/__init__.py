"""Faceted and full-text document search with index upkeep, on Spark DataFrames."""

from findlark.config import Settings
from findlark.registry import IndexSpec, Registry, default_registry

__all__ = ["IndexSpec", "Registry", "Settings", "default_registry"]
