"""Severity names and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.text import is_blank, let, strip

# Severity names and their ranks.
SEVERITY_RANKS = {"NONE": 0, "LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}

NO_SEVERITY = "null"

_NUMBER = r"(?i)\A[+-]?(?:[0-9]+\.?[0-9]*(?:e[+-]?[0-9]+)?|\.[0-9]+(?:e[+-]?[0-9]+)?|nan|inf|infinity)\z"


def normal_severity(col: Column) -> Column:
    return F.upper(strip(col))


def severity_rank(col: Column) -> Column:
    """Rank of a severity name whatever its case and padding; null when unknown."""
    names = F.array(*[F.lit(n) for n in SEVERITY_RANKS])  # listed by rank
    return (F.nullif(F.array_position(names, normal_severity(col)), F.lit(0)) - 1).cast("int")


def severity_bucket(col: Column) -> Column:
    """Normalised severity, with everything unknown in one ``null`` bucket."""
    name = normal_severity(col)
    return F.when(name.isin(list(SEVERITY_RANKS)), name).otherwise(F.lit(NO_SEVERITY))


def to_score(col: Column) -> Column:
    """Text to double; null when it is not a plain number."""
    return _number(strip(col.cast("string")))


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_valid_score(col: Column) -> Column:
    """Blank, or a number from 0 to 10."""
    text = col.cast("string")
    score = let(strip(text), _number)
    return is_blank(text) | let(score, lambda s: s.isNotNull() & s.between(0.0, 10.0))
