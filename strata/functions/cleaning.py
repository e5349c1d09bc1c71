"""Column expressions that clean scraped text and cast it safely.

All of them are built-in Spark SQL functions, so they stay inside
whole-stage code generation. Literal removals use ``replace`` (no regex).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed before numbers are cast, as in the
# source pipeline (thousands separator and the rupee sign).
THOUSANDS_SEPARATOR = ","
CURRENCY_SYMBOLS = ("₹",)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_chars(col: Column | str, chars: Iterable[str]) -> Column:
    """Remove every occurrence of each literal in ``chars``."""
    out = _c(col)
    for ch in chars:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def clean_text(col: Column | str) -> Column:
    """Trim surrounding spaces (0x20 only, like SQL ``trim``)."""
    return F.trim(_c(col))


def clean_label(col: Column | str) -> Column:
    """Trim and lower-case a category label."""
    return F.lower(F.trim(_c(col)))


def to_double(col: Column | str, strip: Iterable[str] = (THOUSANDS_SEPARATOR,)) -> Column:
    """Strip the given literals and ``try_cast`` to double: NULL on bad text."""
    return strip_chars(col, strip).try_cast("double")


def to_price(col: Column | str, symbols: Iterable[str] = CURRENCY_SYMBOLS) -> Column:
    """Remove currency symbols first, then thousands separators, then cast."""
    return to_double(col, (*symbols, THOUSANDS_SEPARATOR))
