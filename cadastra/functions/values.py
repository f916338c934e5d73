"""Numbers, clocks and value scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: last epoch millisecond a 32-bit clock can hold.
MAX_EPOCH_MS = 2147483647000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(c: Column | str) -> Column:
    """Timestamp of an epoch in ms, seconds precision; NULL for absent, NaN or too large."""
    ms = _col(c).cast("double")
    ok = ms.isNotNull() & ~F.isnan(ms) & (ms <= MAX_EPOCH_MS)
    return F.when(ok, F.timestamp_seconds(F.floor(ms / 1000)))


def as_format(c: Column | str, fmt: str) -> Column:
    """Convert a frame column: ``bool``, ``number``, ``text`` or ``timestamp_ms``."""
    c = _col(c)
    if fmt == "bool":
        return F.coalesce(c.cast("boolean"), F.lit(False))
    if fmt == "number":
        number = c.cast("double")
        return F.when(~F.isnan(number), number)
    if fmt == "text":
        return c.cast("string")
    if fmt == "timestamp_ms":
        return epoch_ms(c)
    raise ValueError(f"unknown format {fmt}")


def first_date(*dates) -> Column:
    return F.coalesce(*[_col(d) for d in dates])


def completeness(*cols) -> Column:
    """How many of the columns carry a value."""
    total = F.lit(0)
    for c in cols:
        total = total + _col(c).isNotNull().cast("int")
    return total


def value_per_sqm(
    value: Column | str,
    area: Column | str,
    property_id: Column | str,
    in_hectares: Sequence = (),
    steps: Sequence[int] = (10,),
) -> Column:
    """Land value per square metre.

    Without an area the score is 1 (NULL for a listed id); listed ids hold
    hectares; an area below a step counts as that step (10 alone or 10/50/100).
    """
    value, area, key = _col(value), _col(area), _col(property_id)
    size = area
    for step in sorted(steps, reverse=True):
        size = F.when(area < step, F.lit(float(step))).otherwise(size)
    unknown = area.isNull()
    if len(in_hectares):
        listed = F.coalesce(key.isin(list(in_hectares)), F.lit(False))
        size = F.when(listed, area * 10000).otherwise(size)
        unknown = unknown & ~listed
    return F.when(unknown, F.lit(1.0)).otherwise(value / size)


def blended_score(value: Column | str, linear_share: float) -> Column:
    """Mix of the base-10 log of a value and the value itself."""
    value = _col(value)
    return F.log10(value) * (1 - linear_share) + value * linear_share
