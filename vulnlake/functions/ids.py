"""Identifier checks and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of a well-formed identifier. \A and \z instead of ^ and $,
# because $ also matches before a trailing newline.
ID_PATTERN = r"\ACVE-[0-9]{4}-[0-9]+\z"

UUID_HEX = r"\A[0-9a-fA-F]{32}\z"
UUID4_HEX = r"\A[0-9a-fA-F]{12}4[0-9a-fA-F]{3}[89abAB][0-9a-fA-F]{15}\z"


def is_valid_id(col: Column) -> Column:
    """Well-formed identifier; null counts as malformed. No trimming."""
    return F.coalesce(col.rlike(ID_PATTERN), F.lit(False))


def id_year(col: Column) -> Column:
    """Year inside a well-formed identifier, else null. A storage partition key."""
    return F.when(is_valid_id(col), F.substring(col, 5, 4).cast("int"))


def _uuid_hex(col: Column) -> Column:
    bare = F.replace(F.replace(col, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    return F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit(""))


def is_uuid(col: Column) -> Column:
    """Any UUID; braces, ``urn:uuid:`` and missing hyphens are accepted."""
    return F.coalesce(_uuid_hex(col).rlike(UUID_HEX), F.lit(False))


def is_uuid4(col: Column) -> Column:
    """A version-4 UUID of the standard variant."""
    return F.coalesce(_uuid_hex(col).rlike(UUID4_HEX), F.lit(False))


def surrogate_key(col: Column) -> Column:
    """64-bit key of a value. Null hashes too, so null members still join."""
    return F.xxhash64(col)


def portable_key(col: Column) -> Column:
    """60-bit key any engine with md5 can reproduce; null hashes as an empty text."""
    digest = F.md5(F.coalesce(col.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def name_uuid4(col: Column) -> Column:
    """A UUID with version-4 bits derived from a name.

    A random id changes when a lost task is run again; one derived from the
    row's natural key does not, so a republished row keeps its identity.
    """
    h = F.md5(col)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("4"), F.substring(h, 14, 3)),
        F.concat(F.lit("8"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
