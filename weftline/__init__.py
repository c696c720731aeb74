"""Lineage and catalog-metadata analytics as ordinary Spark jobs."""

from weftline.settings import JobSettings

__all__ = ["JobSettings"]
