"""Vendor field names: prefix and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerbench.constants import VENDOR_PREFIX
from peerbench.functions.text import strip


def strip_prefix(c: Column) -> Column:
    return F.when(
        c.startswith(VENDOR_PREFIX), F.replace(c, F.lit(VENDOR_PREFIX), F.lit(""))
    ).otherwise(c)


def add_prefix(c: Column) -> Column:
    return F.when(c.startswith(VENDOR_PREFIX), c).otherwise(F.concat(F.lit(VENDOR_PREFIX), c))


def field_key(c: Column) -> Column:
    """One spelling per vendor field, whatever way it was requested."""
    return strip_prefix(strip(c))


def field_base(c: Column) -> Column:
    return strip(F.regexp_replace(field_key(c), r"\(Period=[^)]*\)", ""))


def field_period(c: Column) -> Column:
    p = F.regexp_extract(c, r"\(Period=([^)]*)\)", 1)
    return F.when(p != "", p)


def years_back(c: Column) -> Column:
    """FY0 -> 0, FY-1 -> 1; no period means the latest year; other periods are null."""
    p = field_period(c)
    n = F.regexp_extract(p, r"^FY-?(\d+)$", 1)
    return F.when(p.isNull(), 0).when(n != "", n.try_cast("int"))


def field_keys(fields: Sequence[str]) -> list[str]:
    """Distinct common spellings of requested fields, blanks left out."""
    return list(dict.fromkeys(clean_name(f.strip()) for f in fields if f and f.strip()))


def clean_name(field: str) -> str:
    """Driver-side twin of strip_prefix, for naming output columns."""
    return field.replace(VENDOR_PREFIX, "") if field.startswith(VENDOR_PREFIX) else field
