"""Typed casts of messy text: unreadable values become null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelens import schemas
from storelens.functions.text import strip, tokens_to_null

# A plain or scientific decimal number. Words such as "nan" or "1d", which a
# double cast would accept, do not pass.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Date layouts tried after the ISO forms.
DATE_LAYOUTS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "M/d/yy",
    "M-d-yyyy",
    "MMM d, yyyy h:mm a",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
)


def number(c: Column) -> Column:
    """Double of a numeric text, else null."""
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def _without(c: Column, characters: str) -> Column:
    return F.translate(c, characters, "")


def to_string(c: Column) -> Column:
    return strip(tokens_to_null(c))


def to_int(c: Column) -> Column:
    """Whole number, truncated toward zero; commas and percent signs are dropped."""
    return number(_without(tokens_to_null(c), ",%")).try_cast("bigint")


def to_float(c: Column) -> Column:
    """Number; commas and dollar signs are dropped."""
    return number(_without(tokens_to_null(c), ",$"))


def to_percent(c: Column) -> Column:
    """Number divided by one hundred, with or without a percent sign."""
    return number(_without(tokens_to_null(c), "%")) / F.lit(100.0)


def to_datetime(c: Column, layouts: tuple[str, ...] = DATE_LAYOUTS) -> Column:
    """Timestamp of the first layout that reads the text."""
    text = strip(tokens_to_null(c))
    parsed = [F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz") for layout in layouts]
    return F.coalesce(text.try_cast("timestamp_ntz"), *parsed)


CASTS: dict[str, Callable[[Column], Column]] = {
    schemas.STRING: to_string,
    schemas.INT: to_int,
    schemas.FLOAT: to_float,
    schemas.PERCENT: to_percent,
    schemas.DATETIME: to_datetime,
}
