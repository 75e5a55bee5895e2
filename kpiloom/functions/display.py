"""Display text for serving tables: ``$1.2M``, ``12.3%``, ``$1,234.50``.

Values are rounded half-up in decimal before formatting, so the text does
not depend on binary floating-point noise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.money import col_of


def _rounded(c: Column, digits: int) -> Column:
    return F.round(c.try_cast("decimal(38,6)"), digits)


def _text(c: Column, shown: Column) -> Column:
    """``shown``, or the plain text of a number that no decimal holds (an infinity, for example)."""
    return F.coalesce(shown, c.cast("string"))


def millions_text(c: str | Column, digits: int = 1) -> Column:
    """``$<value / 1e6>M`` with ``digits`` decimals and no separators, e.g. ``$12.3M``."""
    return F.concat(F.lit("$"), _text(col_of(c), _rounded(col_of(c) / 1_000_000, digits).cast("string")), F.lit("M"))


def percent_text(c: str | Column, digits: int = 1) -> Column:
    """``<value>%`` with ``digits`` decimals, e.g. ``12.3%``."""
    return F.concat(_text(col_of(c), _rounded(col_of(c), digits).cast("string")), F.lit("%"))


def dollars_text(c: str | Column) -> Column:
    """``$1,234.50``: thousands separators and two decimals."""
    return F.concat(F.lit("$"), _text(col_of(c), F.format_number(_rounded(col_of(c), 2), 2)))
