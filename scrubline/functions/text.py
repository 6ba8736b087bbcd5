"""Column expressions for text cleaning. All are built-in Spark expressions
(JVM side, inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_spaces(c: ColumnOrName) -> Column:
    """Both-side trim of the space character only (tabs/newlines stay)."""
    return F.trim(_c(c))


def strip_trailing(c: ColumnOrName, remove: str = ".") -> Column:
    """Remove every trailing repetition of ``remove``.

    For one character this is ``TRIM(TRAILING c FROM x)``. For a longer string
    the SQL form would treat it as a character *set*, so a regex anchored at
    the end removes whole repetitions of the substring instead.
    """
    if len(remove) == 1:
        return F.rtrim(_c(c), F.lit(remove))
    return F.regexp_replace(_c(c), "(?:" + re.escape(remove) + ")+\\z", "")


def starts_with(c: ColumnOrName, prefix: str, collation: str | None = None) -> Column:
    """Prefix test (``x LIKE 'p%'`` without wildcard pitfalls). With a
    ``collation`` (e.g. ``UTF8_LCASE``) both sides are compared under it.
    NULL input gives NULL (treated as no match by the callers)."""
    col = _c(c)
    lit = F.lit(prefix)
    if collation:
        col = F.collate(col, collation)
        lit = F.collate(lit, collation)
    return F.startswith(col, lit)


def blank_to_null(c: ColumnOrName, blank: str = "") -> Column:
    """``''`` (or the given blank marker) becomes NULL; everything else stays."""
    return F.nullif(_c(c), F.lit(blank))


def text_as_double(c: ColumnOrName) -> Column:
    """Numeric reading of a text column: ``'1'``, ``'1.0'`` -> 1.0; blank or
    junk -> NULL (never an error, also under ANSI mode)."""
    return _c(c).try_cast("double")


def numeric_text_eq(c: ColumnOrName, value: float) -> Column:
    """``text = number`` with numeric semantics; NULL/junk never matches."""
    return F.coalesce(text_as_double(c) == F.lit(float(value)), F.lit(False))
