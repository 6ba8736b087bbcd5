"""Exploration operators: totals by key and period, date span, running total,
top-N per group with ties, and the text-as-number filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_text
from ..functions.names import col as _c
from ..functions.names import collated, fresh, resolve
from ..functions.text import numeric_text_eq
from .cleaning import stage_parquet
from .numbering import slice_count


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_text_equals(df: DataFrame, col: str, value: float,
                        order_by: str | None = None, descending: bool = True) -> DataFrame:
    """``WHERE text_col = <number>`` with numeric meaning (``'1'`` and ``'1.0'``
    match, blank/junk never does), optionally sorted (NULLs last when DESC)."""
    out = df.filter(numeric_text_eq(col, value))
    if order_by is not None:
        out = out.orderBy(F.col(order_by).desc() if descending else F.col(order_by).asc())
    return out


def total_by(df: DataFrame, keys: Sequence[Column | str] | Column | str, measure: Column | str,
             out: str = "total", sort: str | None = "desc",
             collation: str | None = None) -> DataFrame:
    """``SELECT keys, SUM(measure) AS out GROUP BY keys ORDER BY out DESC``.

    Partial + final hash aggregation (map-side combine), so a hot key costs
    one row per map task in the shuffle. The final sort is a range-partitioned
    distributed sort. NULL sums (all-NULL groups) sort last in DESC.
    ``collation``: text keys compare by it; a group is shown as its smallest key by bytes."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    if collation is not None:
        src = df.select(*[_as_col(k) for k in keys], _as_col(measure).alias(out))
        names = src.columns[:-1]
        with_keys, by = collated(src, names, collation)
        agg = with_keys.groupBy(*[_c(b) for b in by]).agg(
            *[F.min(_c(n)).alias(n) for n, b in zip(names, by) if n != b], F.sum(_c(out)).alias(out))
        agg = agg.select(*[_c(n) for n in names], _c(out))
    else:
        agg = _total(df, keys, measure, out)
    if sort == "desc":
        agg = agg.orderBy(F.col(out).desc())
    elif sort == "asc":
        agg = agg.orderBy(F.col(out).asc())
    return agg


def _total(df: DataFrame, keys: list, measure: Column | str, out: str) -> DataFrame:
    return df.groupBy(*[_as_col(k) for k in keys]).agg(F.sum(_as_col(measure)).alias(out))


def total_by_period(df: DataFrame, date_col: str, measure: Column | str, period: str = "year",
                    keys: Sequence[str] = (), out: str = "total", period_name: str | None = None,
                    drop_null_period: bool | None = None, sort: str | None = None) -> DataFrame:
    """Sum per derived period (``year`` -> int, ``month`` -> ``yyyy-MM`` text),
    optionally with extra leading keys. The month form drops NULL periods by
    default (as its ``WHERE month IS NOT NULL`` does); the year form keeps them."""
    if period == "year":
        pcol, name = F.year(date_col), period_name or "year"
        drop = False if drop_null_period is None else drop_null_period
    elif period == "month":
        pcol, name = month_text(date_col), period_name or "month"
        drop = True if drop_null_period is None else drop_null_period
    else:
        raise ValueError(f"unknown period {period!r}")
    src = df.filter(F.col(date_col).isNotNull()) if drop else df
    out_df = total_by(src, [*keys, pcol.alias(name)], measure, out=out, sort=None)
    if sort == "desc":
        out_df = out_df.orderBy(F.col(out).desc())
    elif sort == "asc":
        out_df = out_df.orderBy(F.col(name).asc())
    return out_df


def date_span(df: DataFrame, col: str, earliest: str = "earliest_date",
              latest: str = "latest_date") -> DataFrame:
    """Global ``MIN``/``MAX`` (partial aggregates, one row out)."""
    return df.agg(F.min(col).alias(earliest), F.max(col).alias(latest))


def running_total(df: DataFrame, order_col: str, value_col: str, out: str = "rolling_total",
                  unique_order: bool = False) -> DataFrame:
    """``SUM(value) OVER (ORDER BY order_col)`` with the default RANGE frame:
    every row gets the sum over all rows whose order value is <= its own
    (peers share a total; NULL order values come first).

    A window without PARTITION BY runs in a single task. Instead:
    1. collapse to one row per order value (partial aggregation; skipped when
       the caller states the values are unique),
    2. range-partition those rows, total each slice, and turn slice totals into
       offsets with a window over one row per slice (bounded by the number of
       partitions, broadcast back),
    3. running sum inside each slice + offset,
    4. join the per-value totals back to the rows (skipped when unique).
    """
    order_col, value_col = resolve(df, [order_col, value_col])
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {out!r} already; name another for the total")
    k, v, pid, t, off = fresh([*df.columns, out], "k", "v", "pid", "t", "off")
    if unique_order:
        keyed = df
        vcol, kcol = _c(value_col), _c(order_col)
    else:
        keyed = df.groupBy(_c(order_col).alias(k)).agg(F.sum(_c(value_col)).alias(v))
        vcol, kcol = F.col(v), F.col(k)
    sliced = keyed.repartitionByRange(slice_count(keyed), kcol.asc()).withColumn(
        pid, F.spark_partition_id())
    # Written once: the totals and the rows must see the very same slices, whatever
    # the optimiser prunes or reuses.
    sliced = stage_parquet(sliced, "running_total")
    slice_tot = sliced.groupBy(pid).agg(F.sum(vcol).alias(t))
    # Offset of a slice = sum over all earlier slices; NULL when every earlier
    # value is NULL (SUM skips NULLs and is NULL only over no values).
    offsets = slice_tot.select(
        pid, F.sum(t).over(Window.orderBy(pid).rowsBetween(
            Window.unboundedPreceding, -1)).alias(off))
    inner = F.sum(vcol).over(Window.partitionBy(pid).orderBy(kcol.asc()))
    total = (F.when(inner.isNull() & F.col(off).isNull(), F.lit(None))
             .otherwise(F.coalesce(inner, F.lit(0)) + F.coalesce(F.col(off), F.lit(0))))
    prefixed = sliced.join(F.broadcast(offsets), pid).withColumn(out, total)
    if unique_order:
        return prefixed.select(*[_c(c) for c in df.columns], _c(out))
    totals = prefixed.select(F.col(k), _c(out))
    joined = df.join(totals, _c(order_col).eqNullSafe(F.col(k)), "left")
    return joined.select(*[_c(c) for c in df.columns], _c(out))


def top_n_per_group(df: DataFrame, group: str | Sequence[str], order_col: str, n: int = 5,
                    rank_col: str = "ranking", descending: bool = True,
                    drop_null_group: bool = True, stage: bool = False,
                    collation: str | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY order_col DESC) <= n``.

    Ties share a rank, so more than ``n`` rows per group can come out. No window
    goes over the rows: the group's distinct values are found first (partial
    aggregation, so a tied value is one row per map task), their ``n`` best are
    ranked (with a partial limit before the shuffle), and the rows are joined to these
    thresholds, at most ``n`` rows per group. AQE can split a value that many rows share.

    ``stage=True`` writes the thresholds first. Their size is then known when the
    join is planned, and where Spark broadcasts such a size the rows stay where they were
    read: for large tables whose groups are few. It runs a job while it is built.
    ``collation``: text groups compare by it."""
    groups = resolve(df, group)
    value, = resolve(df, order_col)
    if collation is not None:
        with_groups, by = collated(df, groups, collation)
        return top_n_per_group(with_groups, by, value, n, rank_col, descending, drop_null_group,
                               stage).select(*[_c(c) for c in df.columns], _c(rank_col))
    if rank_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {rank_col!r} already; name another for the rank")
    src = df
    if drop_null_group:
        for g in groups:
            src = src.filter(_c(g).isNotNull())
    names = fresh([*df.columns, rank_col], *[f"g{i}" for i in range(len(groups))], "value")
    keys, best = names[:-1], names[-1]
    o = F.col(best).desc() if descending else F.col(best).asc()
    values = src.select(*[_c(g).alias(k) for g, k in zip(groups, keys)],
                        _c(value).alias(best)).distinct()
    # Distinct values: their row number is the dense rank of the rows.
    limits = values.withColumn(rank_col, F.row_number().over(
        Window.partitionBy(*keys).orderBy(o))).filter(_c(rank_col) <= n)
    if stage:
        limits = stage_parquet(limits, "top_n")
    same = _c(value).eqNullSafe(F.col(best))
    for g, k in zip(groups, keys):
        same = same & _c(g).eqNullSafe(F.col(k))
    return src.join(limits, same).select(*[_c(c) for c in df.columns], _c(rank_col))
