"""Date/period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c

# Fixed value: month/day written with one or two digits, four-digit year.
US_DATE_FORMAT = "M/d/yyyy"


def parse_date(c: ColumnOrName, fmt: str = US_DATE_FORMAT, strict: bool = False) -> Column:
    """Text -> DATE. Unparseable or impossible dates (``2/30/2023``) give NULL;
    ``strict=True`` raises instead."""
    return F.to_date(_c(c), fmt) if strict else F.try_to_date(_c(c), fmt)


def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    """Text -> zone-less TIMESTAMP_NTZ; bad values give NULL.

    Parsed straight to NTZ (no session time zone involved, so no DST shift);
    ``to_timestamp_ntz`` runs only where the lenient parse succeeds, so
    malformed text is NULL under ANSI mode too."""
    col = _c(c)
    return F.when(F.try_to_timestamp(col, F.lit(fmt)).isNotNull(),
                  F.to_timestamp_ntz(col, F.lit(fmt)))


def month_text(c: ColumnOrName) -> Column:
    """``yyyy-MM`` of a date/timestamp (what ``SUBSTRING(date, 1, 7)`` yields)."""
    return F.date_format(_c(c), "yyyy-MM")


def year_of(c: ColumnOrName) -> Column:
    return F.year(_c(c))
