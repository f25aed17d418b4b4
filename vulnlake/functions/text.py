"""Blank handling, trimming and defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Unicode calls whitespace; Spark's one-argument trim only knows the space.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Texts that stand for "no value" in affected-product entries, lower case.
PLACEHOLDERS = ["", "n/a", "na", "unknown", "none", "-", "*", "not available"]

# Texts that a loaded CSV treats as null.
NULL_MARKERS = ["", "NaN", "NULL", "null"]


def strip(col: Column) -> Column:
    """Text without surrounding whitespace of any kind."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    """Null, empty or whitespace only. Trimming the left end alone stops at the first real character.

    Text that begins with a printable ASCII character is not trimmed: two comparisons tell.
    """
    begins = (col >= "!") & (col < "\x7f")
    return col.isNull() | (~begins & (F.ltrim(col, F.lit(WHITESPACE)) == ""))


def nullify(col: Column) -> Column:
    """Blank becomes null; anything else is returned untouched."""
    return F.when(~is_blank(col), col)


def default_blank(col: Column, default: str) -> Column:
    """Null or exactly empty becomes ``default``. Deliberately does not trim."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def clean_placeholder(col: Column) -> Column:
    """Stripped text, with null and placeholder words turned into an empty text."""
    text = strip(col)
    return F.when(F.lower(text).isin(PLACEHOLDERS), F.lit("")).otherwise(F.coalesce(text, F.lit("")))


def null_markers(col: Column) -> Column:
    """Stripped text, with CSV null markers turned into null."""
    text = strip(col)
    return F.when(~text.isin(NULL_MARKERS), text)


def first_nonblank(values: Column) -> Column:
    """First non-blank text of an array, stripped; empty text when there is none."""
    kept = F.filter(values, lambda v: ~is_blank(v))
    return F.coalesce(strip(F.try_element_at(kept, F.lit(1))), F.lit(""))


def join_distinct(values: Column) -> Column:
    """Distinct non-blank texts in first-seen order, comma separated, empty text if none."""
    kept = F.filter(values, lambda v: ~is_blank(v))
    return F.coalesce(F.concat_ws(",", F.array_distinct(kept)), F.lit(""))


def flatten_safe(outer: Column, inner) -> Column:
    """Flatten ``inner(element)`` over an array, skipping elements whose inner array is null.

    ``flatten`` alone returns null as soon as one inner array is null.
    """
    return F.flatten(F.filter(F.transform(outer, inner), lambda a: a.isNotNull()))


def email_domain(col: Column) -> Column:
    """Lower-case text after the last ``@`` (the whole text when there is none)."""
    return F.lower(F.substring_index(strip(col), "@", -1))


def date_text(col: Column) -> Column:
    """The date part of an ISO text."""
    return F.substring(col, 1, 10)


def quoted(col: Column) -> Column:
    """Text in single quotes for messages, ``None`` for null."""
    return F.when(col.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), col, F.lit("'")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it.

    Filters are pushed below projections by copying the column's definition into
    every place it is used. For an expensive column behind a large check that
    multiplies the work and the plan, so such a check binds its input here.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
