"""Typed readers for text fields.

A *reader* turns a text column into a value column.  Readers never raise: a
value that cannot be read becomes NULL, and ``unreadable`` marks it, so that a
job can either report rejects or fail on them (``operators.quality``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The publishers' date formats. Single-letter day and month
# accept one- and two-digit parts.
DATE_COMPACT = "yyyyMMdd"
STAMP_COMPACT = "yyyyMMdd HH:mm"
DATE_SLASHED = "d/M/yyyy"
DATE_FILE_NAME = "ddMMyyyy"

# Area units a record may carry.
AREA_UNITS = ("M", "H", "U")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    """Turn the empty string into NULL, keeping inner and outer blanks."""
    return F.nullif(_col(c), F.lit(""))


def read_int(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("int")


def read_long(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("bigint")


def read_double(c: Column | str) -> Column:
    return F.trim(_col(c)).try_cast("double")


def read_date(c: Column | str, fmt: str = DATE_COMPACT) -> Column:
    return F.try_to_date(empty_to_null(c), fmt)


def read_timestamp(c: Column | str, fmt: str = STAMP_COMPACT) -> Column:
    return F.try_to_timestamp(empty_to_null(c), F.lit(fmt))


def read_postcode(c: Column | str) -> Column:
    c = _col(c)
    return F.when(F.length(c) == 4, c)


def read_area_unit(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.isin(*AREA_UNITS), c)


def read_text(c: Column | str, min_len: int | None = None, max_len: int | None = None) -> Column:
    """Text whose length lies within the bounds, else NULL."""
    c = empty_to_null(c)
    size = F.length(c)
    ok = F.lit(True)
    if min_len is not None:
        ok = ok & (size >= min_len)
    if max_len is not None:
        ok = ok & (size <= max_len)
    return F.when(ok, c)


def unreadable(text: Column | str, value: Column, required: bool = False) -> Column:
    """True where the text was present but gave no value (or is missing though required)."""
    text = _col(text)
    given = text.isNotNull() & (text != "")
    bad = given & value.isNull()
    if required:
        bad = bad | ~F.coalesce(given, F.lit(False))
    return F.coalesce(bad, F.lit(False))


def or_fail(text: Column | str, value: Column, what: str, required: bool = False) -> Column:
    """The value, or a failed job naming the field and the offending text."""
    text = _col(text)
    message = F.concat(F.lit(f"cannot read {what}: "), F.coalesce(text, F.lit("<null>")))
    return F.when(unreadable(text, value, required), F.raise_error(message)).otherwise(value)
