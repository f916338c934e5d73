"""Every operator as a query over the shared test tables, with equivalent SQL."""

from . import derivations, linking, quality, questions, reductions, roundtrips, scalars, spatial  # noqa: F401
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
