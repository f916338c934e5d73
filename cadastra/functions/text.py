"""Address and name composition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def address_line(number, street, locality, postcode) -> Column:
    """One line; NULL as soon as one part is missing."""
    parts = [_col(p) for p in (number, street, locality, postcode)]
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit(" "), part]
    return F.concat(*spaced)


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def joined(*parts) -> Column:
    """Concatenate, skipping missing parts."""
    return F.concat(*[or_empty(p) for p in parts])


def before(c: Column | str, sep: str) -> Column:
    """``sep`` then the value, or nothing when the value is missing."""
    return F.coalesce(F.concat(F.lit(sep), _col(c).cast("string")), F.lit(""))


def after(c: Column | str, sep: str) -> Column:
    """The value then ``sep``, or nothing when the value is missing."""
    return F.coalesce(F.concat(_col(c).cast("string"), F.lit(sep)), F.lit(""))


def level_label(kind, prefix, number, suffix) -> Column:
    return F.concat(after(kind, " "), after(prefix, "-"), or_empty(number), before(suffix, "-"))


def house_label(first_prefix, first, first_suffix, last_prefix, last, last_suffix) -> Column:
    """``12A-14B``; the second number appears only when all its parts are known."""
    tail = F.coalesce(
        F.concat(F.lit("-"), *[_col(c).cast("string") for c in (last_prefix, last, last_suffix)]),
        F.lit(""),
    )
    return F.concat(joined(first_prefix, first, first_suffix), tail)


def street_label(name, kind, suffix) -> Column:
    """Street name with optional type and suffix; NULL without a name."""
    return F.concat(_col(name), before(kind, " "), before(suffix, " "))


def upper_name(c: Column | str) -> Column:
    return F.upper(_col(c))
