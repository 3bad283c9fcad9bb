"""Column functions of the corpus engine."""

from . import hashing, markup, text, urls

__all__ = ["hashing", "markup", "text", "urls"]
