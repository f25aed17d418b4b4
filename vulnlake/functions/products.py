"""Product identification: CPE 2.3 names and affected-product entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.text import clean_placeholder, flatten_safe, strip

# Fixed values of the CPE 2.3 formatted-string binding.
CPE_PREFIX = "cpe:2.3:"
CPE_PARTS = 13
CPE_NO_VALUE = ["*", "-"]

_UNESCAPED_COLON = r"(?<!\\):"


def parse_cpe(col: Column, escaped: bool = False) -> Column:
    """CPE 2.3 name to struct(vendor, product, version, part, cpe_uri), all empty when invalid.

    ``escaped=True`` splits on unescaped colons only, so names that contain ``\\:`` keep
    their thirteen parts; by default such names count as invalid.
    """
    text = strip(col)
    split = F.split(text, _UNESCAPED_COLON if escaped else ":")
    parts = F.when(text.startswith(CPE_PREFIX) & (F.size(split) == CPE_PARTS), split)

    def part(index: int) -> Column:
        return F.coalesce(F.try_element_at(parts, F.lit(index)), F.lit(""))

    def value(index: int) -> Column:
        return F.when(part(index).isin(CPE_NO_VALUE), F.lit("")).otherwise(part(index))

    return F.struct(
        value(4).alias("vendor"),
        value(5).alias("product"),
        value(6).alias("version"),
        part(3).alias("part"),
        F.when(parts.isNotNull(), text).otherwise(F.lit("")).alias("cpe_uri"),
    )


def first_cpe(configurations: Column) -> Column:
    """First CPE 2.3 name over configurations, nodes and matches, stripped; null when none."""
    nodes = flatten_safe(configurations, lambda c: c["nodes"])
    matches = flatten_safe(nodes, lambda n: n["cpeMatch"])
    names = F.filter(F.transform(matches, lambda m: strip(m["criteria"])), lambda c: c.startswith(CPE_PREFIX))
    return F.try_element_at(names, F.lit(1))


def affected_entries(affected: Column) -> Column:
    """All affected-product entries of a record as one array, null entries dropped."""
    return F.filter(flatten_safe(affected, lambda a: a["affectedData"]), lambda d: d.isNotNull())


def select_entry(entries: Column) -> Column:
    """First entry that names a vendor, else the first that names a product, else null."""
    with_vendor = F.filter(entries, lambda d: clean_placeholder(d["vendor"]) != "")
    with_product = F.filter(entries, lambda d: clean_placeholder(d["product"]) != "")
    return F.coalesce(F.try_element_at(with_vendor, F.lit(1)), F.try_element_at(with_product, F.lit(1)))


def affected_status(entries: Column) -> Column:
    """``affected`` beats ``unaffected`` over all entries; empty text otherwise.

    The status "unknown" is one of the placeholder words, so it never survives
    cleaning and reads as an empty text.
    """
    # Each entry's rank is its position in this list; the highest one speaks for the record.
    names = F.array(*[F.lit(n) for n in ("", "unaffected", "affected")])
    ranks = F.transform(entries, lambda d: F.array_position(names, F.lower(clean_placeholder(d["defaultStatus"]))))
    return F.element_at(names, F.greatest(F.coalesce(F.array_max(ranks), F.lit(1)), F.lit(1)).cast("int"))
