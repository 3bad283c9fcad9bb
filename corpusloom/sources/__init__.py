"""Sources and sinks of the corpus engine."""

from . import readers

__all__ = ["readers"]
