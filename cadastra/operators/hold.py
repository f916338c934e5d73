"""Keep an expensive column from being computed more than once per row.

A filter on a computed column is moved below it by copying the expression, and
projections are merged by copying too; for parsers and geometry this multiplies
the work.  An expression depending on the row's place in its task is never
copied, so wrapping a column in a condition of that kind, one that always
holds, pins it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hold(c: Column) -> Column:
    """The same value, computed where it is written."""
    return F.when(F.monotonically_increasing_id() >= 0, c)
