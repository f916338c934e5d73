"""Connected components of a link table (the library's general helper)."""

from ..operators.components import components

__all__ = ["components"]
