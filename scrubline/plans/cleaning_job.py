"""J-1: the cleaning job, configured by column names.

Order matters and follows the original script: exact-duplicate removal runs
*before* trimming (rows that differ only in spaces both survive unless
``second_dedupe``), blanks become NULL before the peer fill, and rows with
no measure at all are dropped last. The whole job is one lazy lineage:
Catalyst collapses the updates into one projection; the dedup aggregate is
the one full shuffle. The result is staged once before the peer fill, whose
donor aggregate reads two columns and whose join moves only the rows that
need a value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.dates import US_DATE_FORMAT
from ..operators import cleaning as C


@dataclass(frozen=True)
class CleanSpec:
    # The columns and rules of the layoffs cleaning script.
    dedupe_keys: Sequence[str] | None = None  # None: all columns (exact copies)
    trim_cols: Sequence[str] = ("company",)
    prefix_rules: Sequence[tuple[str, str, str]] = (("industry", "Crypto", "Crypto"),)
    strip_rules: Sequence[tuple[str, str, str]] = (("country", ".", "United States"),)
    date_col: str | None = "date"
    date_format: str = US_DATE_FORMAT
    blank_cols: Sequence[str] = ("industry",)
    fill_key: str | None = "company"
    fill_cols: Sequence[str] = ("industry",)
    measure_cols: Sequence[str] = ("total_laid_off", "percentage_laid_off")
    drop_cols: Sequence[str] = field(default_factory=tuple)
    second_dedupe: bool = False
    # Write the deduplicated, standardised table once (Parquet under the
    # shared folder) before the peer fill, which reads it three ways (rows to
    # keep, rows to fill, donors). Without it the dedup shuffle is recomputed
    # per branch, because filters are pushed below it and defeat exchange
    # reuse; the staged copy also cuts lineage for executor-loss recovery.
    stage_before_fill: bool = True
    strict_dates: bool = False
    collation: str | None = None


def clean(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Raw table -> cleaned table (same columns, date column typed DATE)."""
    df = C.dedupe(raw, spec.dedupe_keys, order=None if spec.dedupe_keys is None
                  else list(raw.columns))
    if spec.trim_cols:
        df = C.trim(df, spec.trim_cols)
    for col, prefix, value in spec.prefix_rules:
        df = C.canonicalize_prefix(df, col, prefix, value, collation=spec.collation)
    for col, chars, where_prefix in spec.strip_rules:
        df = C.strip_trailing(df, col, chars, where_prefix=where_prefix, collation=spec.collation)
    if spec.date_col:
        df = C.parse_date(df, spec.date_col, spec.date_format, strict=spec.strict_dates)
    if spec.blank_cols:
        df = C.blank_to_null(df, spec.blank_cols)
    if spec.second_dedupe:
        df = C.dedupe(df)
    if spec.fill_key and spec.fill_cols:
        df = C.fill_from_peers(df, spec.fill_key, spec.fill_cols, stage=spec.stage_before_fill)
    if spec.measure_cols:
        df = C.drop_all_null(df, spec.measure_cols)
    for c in spec.drop_cols:
        df = df.drop(c)
    return df
