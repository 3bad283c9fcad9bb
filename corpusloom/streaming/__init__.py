"""Streaming and iterative operators of the corpus engine."""

from . import incremental

__all__ = ["incremental"]
