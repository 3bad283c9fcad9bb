"""Operators of the corpus engine."""

from . import aggregates, dedup, filters, packaging, sections

__all__ = ["aggregates", "dedup", "filters", "packaging", "sections"]
