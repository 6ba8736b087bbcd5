"""Skew-safe numbering of rows within a key (``ROW_NUMBER() OVER (PARTITION
BY keys ORDER BY ...)``).

A plain window sends every row of a key to one task; if one key holds a
third of the table, that task holds a third of the table. Here the rows are
range-partitioned on (keys, order, remaining columns) instead, so a hot key
is cut into several contiguous slices. Each slice is numbered locally
(window over ``(partition id, keys)`` -- bounded by one range partition),
and the only cross-slice information needed -- how many rows of a key lie in
earlier slices -- comes from a table with one row per range partition,
which is small by construction and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import col, fresh


def slice_count(df: DataFrame) -> int:
    """Number of range slices. Given explicitly, so AQE never coalesces the
    range shuffle: slice ids (``spark_partition_id``) must be the same in
    every branch that reads it."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sort_exprs(names_dirs):
    return [col(n).asc() if a else col(n).desc() for n, a in names_dirs]


def key_row_number(df: DataFrame, keys: list[str], spec: list[tuple[str, bool]],
                   out: str = "row_num", strategy: str = "range") -> DataFrame:
    order_names = [n for n, _ in spec]
    ties = [(c, True) for c in df.columns if c not in keys and c not in order_names]
    local_order = _sort_exprs(spec + ties)
    key_cols = [col(k) for k in keys]
    if strategy == "window":
        w = Window.partitionBy(*key_cols).orderBy(*local_order)
        return df.withColumn(out, F.row_number().over(w))
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    pid, local_, first, last, last_n, cum, offset, before, so_far = fresh(
        [*df.columns, out], "pid", "local", "first", "last_key", "last_n", "cum", "offset",
        "before", "so_far")

    full_order = _sort_exprs([(k, True) for k in keys]) + local_order
    sliced = df.repartitionByRange(slice_count(df), *full_order).withColumn(
        pid, F.spark_partition_id())
    # Written once: bounds, counts and rows must see the very same slices, whatever
    # the optimiser prunes or reuses.
    from .cleaning import stage_parquet

    sliced = stage_parquet(sliced, "numbering")
    local = sliced.withColumn(
        local_, F.row_number().over(Window.partitionBy(pid, *key_cols).orderBy(*local_order)))

    key_struct = F.struct(*key_cols)
    # One row per non-empty slice: its first and last key, and how many rows
    # the last key has in the slice. Read from the range shuffle (key columns
    # only, no re-sort of full rows): bounds first, then a count of the rows
    # equal to the slice's last key against those (one row per slice) bounds.
    bounds = sliced.groupBy(pid).agg(F.min(key_struct).alias(first),
                                     F.max(key_struct).alias(last))
    # The bounds are carried through the count (not joined again), so they
    # are computed once.
    edges = (sliced.join(F.broadcast(bounds), pid)
             .filter(key_struct.eqNullSafe(F.col(last)))
             .groupBy(pid, first, last).agg(F.count(F.lit(1)).alias(last_n)))
    # Rows of a key in earlier slices = running sum of its slice-final counts.
    by_last = Window.partitionBy(last).orderBy(pid).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edges = edges.withColumn(cum, F.sum(last_n).over(by_last))
    in_order = Window.orderBy(pid)  # one row per slice: bounded by the partition count
    edges = edges.select(pid, first, F.lag(last).over(in_order).alias(before),
                         F.lag(cum).over(in_order).alias(so_far))
    edges = edges.select(pid, first, F.when(
        F.col(first).eqNullSafe(F.col(before)), F.col(so_far)).otherwise(F.lit(0)).alias(offset))

    joined = local.join(F.broadcast(edges), on=pid, how="left")
    number = F.col(local_) + F.when(key_struct.eqNullSafe(F.col(first)), F.col(offset)) \
        .otherwise(F.lit(0))
    return joined.select(*[col(c) for c in df.columns], number.cast("int").alias(out))
