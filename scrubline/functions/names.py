"""Column names: helper columns that clash with nothing, and names as Spark
resolves them (without regard to case, unless the session says otherwise)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(taken: DataFrame | Iterable[str], *bases: str) -> list[str]:
    """One new column name per base that neither ``taken`` nor another has."""
    used = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    out = []
    for base in bases:
        name = f"_{base}"
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def resolve(df: DataFrame, names: str | Sequence[str]) -> list[str]:
    """The columns of ``df`` that ``names`` stand for, as the table spells them."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    known = {c if sensitive else c.lower(): c for c in df.columns}
    out = []
    for n in [names] if isinstance(names, str) else names:
        try:
            out.append(known[n if sensitive else n.lower()])
        except KeyError:
            raise ValueError(f"no column {n!r} among {df.columns}") from None
    return out


def col(name: str) -> Column:
    """A column by its very name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def collated(df: DataFrame, names: Sequence[str], collation: str) -> tuple[DataFrame, list[str]]:
    """``df`` with helper columns in which the text columns among ``names`` compare as
    ``collation`` has it (such as ``UNICODE_CI_AI``: without regard to case and accents),
    and the names to compare by. The columns themselves stay as they are."""
    text = [n for n in names if df.schema[n].dataType.typeName() == "string"]
    helper = dict(zip(text, fresh(df, *[f"as{i}" for i in range(len(text))])))
    return (df.withColumns({h: F.collate(col(n), collation) for n, h in helper.items()}),
            [helper.get(n, n) for n in names])
