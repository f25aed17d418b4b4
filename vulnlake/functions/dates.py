"""Dates, instants and ISO-8601 checks. Nothing here depends on the session time zone
except where a result type itself does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.text import let, strip

_DATE = r"(?:[0-9]{4}-(?:0[1-9]|1[0-2])-[0-3][0-9]|[0-9]{4}(?:0[1-9]|1[0-2])[0-3][0-9]|[0-9]{4}-?W(?:0[1-9]|[1-4][0-9]|5[0-3])(?:-?[1-7])?)"
_HH, _MM = r"(?:[01][0-9]|2[0-3])", r"[0-5][0-9]"
_FRACTION = r"(?:[.,][0-9]+)?"
_TIME = rf"(?:{_HH}(?::{_MM}(?::{_MM}{_FRACTION})?)?|{_HH}(?:{_MM}(?:{_MM}{_FRACTION})?)?)"
_OFFSET = rf"(?:Z|[+-]{_HH}(?::?{_MM}(?::?{_MM}(?:[.][0-9]+)?)?)?)"

_AWARE = rf"\A{_DATE}[^Z]{_TIME}{_OFFSET}\z"
_ANY = rf"\A{_DATE}(?:[^Z]{_TIME}{_OFFSET}?)?\z"
_WEEK_DATE = r"\A[0-9]{4}-?W"


def _matches(text: Column, pattern: str) -> Column:
    """Does the text have the form, and does its leading date exist in the calendar?

    Week dates are checked by form alone.
    """
    begin = F.substring(text, 1, 10)
    compact = F.regexp_replace(begin, r"\A([0-9]{4})([0-9]{2})([0-9]{2}).*", "$1-$2-$3")
    day = F.when(F.substring(text, 5, 1) == "-", begin).otherwise(compact)
    return F.coalesce(text.rlike(pattern) & (day.try_cast("date").isNotNull() | text.rlike(_WEEK_DATE)), F.lit(False))


def is_iso8601(col: Column) -> Column:
    """ISO-8601 date and time that carries a UTC offset."""
    return let(strip(col), lambda text: _matches(text, _AWARE))


def with_offset(col: Column) -> Column:
    """Naive ISO text gets ``+00:00``; aware text is stripped; anything else is unchanged."""
    text = strip(col)
    offset = F.when(text.rlike(_AWARE), F.lit("")).otherwise(F.lit("+00:00"))
    return F.when(_matches(text, _ANY), F.concat(text, offset)).otherwise(col)


def to_instant(col: Column) -> Column:
    """ISO text to a timestamp, naive text read as UTC; null when malformed."""
    text = strip(col)
    # An offset after an offset does not parse, so aware text takes the second form.
    return F.coalesce(F.concat(text, F.lit("+00:00")).try_cast("timestamp"), text.try_cast("timestamp"))


def utc_wall_time(instant: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def to_ntz(col: Column) -> Column:
    """ISO text to a timestamp without time zone, at its UTC wall time."""
    return utc_wall_time(to_instant(col))


def to_day(col: Column) -> Column:
    """Date part of an ISO text; null instead of an error when malformed."""
    return col.try_cast("date")


def date_parts(day: Column) -> dict[str, Column]:
    """Calendar columns of a date."""
    return {"year": F.year(day), "month": F.month(day), "quarter": F.quarter(day)}


def days_since(day: Column, as_of: Column | None = None) -> Column:
    """Whole days from ``day`` to ``as_of`` (today when not given)."""
    return F.datediff(F.current_date() if as_of is None else as_of, day)


def iso_text(instant: Column) -> Column:
    """Timestamp to ISO text in UTC with an explicit offset."""
    return F.date_format(utc_wall_time(instant), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def now_iso() -> Column:
    return iso_text(F.current_timestamp())
