"""URI handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"\A([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def redact_uri(col: Column) -> Column:
    """``scheme://host[:port]`` only: user, password, path and query never survive."""
    scheme = F.lower(F.regexp_extract(col, _SCHEME, 1))
    authority = F.substring_index(F.regexp_extract(col, _AUTHORITY, 1), "@", -1)
    bracketed = authority.startswith("[")
    host = F.lower(
        F.when(bracketed, F.regexp_extract(authority, r"\A\[([^\]]*)\]", 1)).otherwise(
            F.substring_index(authority, ":", 1)
        )
    )
    port = F.regexp_extract(authority, r":0*([1-9][0-9]*)\z", 1)
    return F.concat(scheme, F.lit("://"), host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(F.lit("")))
